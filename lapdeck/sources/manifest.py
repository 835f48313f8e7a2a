"""File manifests (S7, S8): landed objects as a DataFrame.

``binaryFile`` lists files in parallel through the Hadoop FileSystem API;
selecting only path / length / modificationTime prunes the content column,
so no file body is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.operators.catalog import parse_manifest


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of every file under ``root``."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(root)
            .select("path", "length", "modificationTime"))


def manifest(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """S7 + key parsing: adds rel_path, year_part, event, session, data_type."""
    return parse_manifest(list_files(spark, root, glob), root)


def child_prefixes(files: DataFrame, depth: int = 1) -> DataFrame:
    """Distinct first ``depth`` path parts (``list prefixes``)."""
    parts = F.split("rel_path", "/")
    return (files.select(F.array_join(F.slice(parts, 1, depth), "/").alias("prefix"))
            .distinct())


def ingest_summary(files: DataFrame) -> DataFrame:
    """Objects and MB by data type, by year part, and in total (one
    grouping-sets aggregate; all seven data types are counted)."""
    g = files.groupingSets([["data_type"], ["year_part"], []], "data_type", "year_part")
    out = g.agg(F.count(F.lit(1)).alias("objects"),
                (F.sum("length") / 1048576.0).alias("size_mb"),
                F.grouping("data_type").alias("__gt"), F.grouping("year_part").alias("__gy"))
    level = (F.when(F.col("__gt") == 0, F.lit("data_type"))
             .when(F.col("__gy") == 0, F.lit("year")).otherwise(F.lit("total")))
    return out.select("data_type", "year_part", level.alias("level"), "objects", "size_mb")
