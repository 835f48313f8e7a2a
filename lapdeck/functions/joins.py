"""Join per-key facts back to the rows they were aggregated from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapdeck.session import scratch_path


def join_back(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "left", salts: int = 64) -> DataFrame:
    """Join one-row-per-key ``facts`` to ``rows`` on ``keys`` (null-safe: NULL keys match each other, like groupBy).

    A key may hold a third of all rows, and AQE cannot split a join whose one side is an aggregate.  So
    every row gets a salt from its place (partition and row number: equal rows differ), and the facts go to the salts
    that their key was seen with.  The salts are used twice, and after a shuffle a second run may number the rows
    differently, so the salted rows are written once to the shared checkpoint folder and read from there.  There are never
    more such facts than rows, and a join task gets at most a ``salts``-th of any key.  One plan for every size: no row-count switch.
    """
    numbered = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    path = scratch_path(rows.sparkSession, "salted-rows")
    numbered.write.parquet(path)
    salted = rows.sparkSession.read.schema(numbered.schema).parquet(path)
    seen = salted.select(*keys, "__salt").distinct()  # combined map-side
    f = facts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    here = seen.join(f, [seen[k].eqNullSafe(f[f"__k_{k}"]) for k in keys]).drop(*keys).withColumnRenamed("__salt", "__fsalt")
    on = [salted[k].eqNullSafe(here[f"__k_{k}"]) for k in keys] + [salted["__salt"] == here["__fsalt"]]
    return salted.join(here, on, how).drop("__salt", "__fsalt", *[f"__k_{k}" for k in keys])
