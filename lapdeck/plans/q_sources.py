"""Sinks and scans (S4, S5, S6, S9, S10, S11) as round trips over the given
tables: data is written with lapdeck's sinks into the shared checkpoint
folder and read back with its readers, so the result must equal the input
(the reference's "round trip keeps row count and column set")."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.functions.columns import event_key
from lapdeck.plans.registry import register, rounded, table
from lapdeck.session import scratch_path
from lapdeck.sources.readers import read_sessions
from lapdeck.sources.sinks import write_sample, write_sessions

SQL_ROUNDTRIP = """
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       replace(lower(o_orderpriority), ' ', '_') AS event, o_orderstatus AS session
FROM orders
"""


@register("sink_roundtrip", SQL_ROUNDTRIP, "S4 S6 S9 S11 (partitioned write, rewrite, read)")
def q_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "sessions")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.year("o_orderdate").alias("year"),
        event_key("o_orderpriority").alias("event"), F.col("o_orderstatus").alias("session"))
    write_sessions({"orders": o}, root, compression="zstd")
    # Re-land one session kind; dynamic overwrite replaces only those folders
    write_sessions({"orders": o.filter(F.col("session") == "P")}, root, compression="snappy")
    back = read_sessions(spark, root, "orders")
    return rounded(back.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                               F.col("year").cast("int").alias("year"), "event", "session"))


_SAMPLE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]

SQL_SAMPLE = f"""
SELECT {", ".join(_SAMPLE_ORDER)} FROM lineitem
ORDER BY {", ".join(_SAMPLE_ORDER)} LIMIT 100
"""


@register("sample_first100", SQL_SAMPLE, "S5 S10 (first 100 rows as CSV, read back)")
def q_sample(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*_SAMPLE_ORDER)
    path = scratch_path(spark, "sample")
    write_sample(li, path, _SAMPLE_ORDER, 100)
    return spark.read.option("header", True).schema(li.schema).csv(path)
