"""Query registry: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL).

Each builder runs a lapdeck operator over the driver's tables at full size;
each SQL string is an independent formulation of the same result for DuckDB.
Doubles are rounded to 6 decimals on both sides, counts are BIGINT on both.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: str  # SURVEY ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ops: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation for the oracle comparison)."""
    return df.withColumns({
        f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    })


def load_all() -> dict[str, Query]:
    # imported for the side effect of registration
    for mod in ("q_sequences", "q_results", "q_catalog", "q_validation", "q_checks",
                "q_planning", "q_changes", "q_sources", "q_landed", "q_rules"):
        importlib.import_module(f"lapdeck.plans.{mod}")
    return REGISTRY
