"""Training-data pipeline over ``documents``: each stage's result is written as Parquet and is the next one's input.

1. quality: the weak-label classifier; documents that it rejects go.
2. near duplicates: the n-gram Jaccard join; one document of each group stays.
3. decontamination: documents that contain a benchmark item go.
4. secrets: findings judged secret are masked in the text, and n_chars is counted anew.
5. mixing: the documents read by the mix, with how often it reads each.

The stages keep the columns of ``documents``; the last one adds the mix's plan.  SQL cannot express
the trained stages, so there is no ``ORACLE_SQL``; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.llm import leaks, mixing, near, quality, secret_scan
from lapdeck.llm.common import materialise
from lapdeck.plans.registry import table

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.first_of_groups(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads: their columns, size, source_size, target, first_finish, copies and taken."""
    return mixing.mixed_documents(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", decontaminate),
          ("secrets", mask_secrets), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
