"""Change detection (T1, T2) and incremental refresh.

Roles: a file = an order; path = the order key, size = total price, mtime =
order date, year part = year of the order date.  The old snapshot holds the
orders not in status P, the new one those not in status F, and urgent
orders change size in the new snapshot -- so new, deleted, modified and
unchanged files all occur.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.operators.changes import bucket_state, diff_counts, manifest_diff
from lapdeck.plans.registry import register, rounded, table


def _files(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("path"),
        F.col("o_totalprice").alias("length"),
        F.col("o_orderdate").alias("modificationTime"),
        F.year("o_orderdate").cast("string").alias("year_part"),
        "o_orderstatus", "o_orderpriority")


def _snapshots(spark, sf_dir):
    f = _files(spark, sf_dir)
    old = f.filter(F.col("o_orderstatus") != "P")
    new = (f.filter(F.col("o_orderstatus") != "F")
           .withColumn("length", F.when(F.col("o_orderpriority") == "1-URGENT",
                                        F.col("length") * 1.1).otherwise(F.col("length"))))
    return old, new


_SNAP = """
WITH f AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS path, o_totalprice AS length,
         o_orderdate AS mtime, o_orderstatus, o_orderpriority FROM orders
), old AS (SELECT path, length, mtime FROM f WHERE o_orderstatus <> 'P'),
new AS (SELECT path, CASE WHEN o_orderpriority = '1-URGENT' THEN length * 1.1 ELSE length END
               AS length, mtime FROM f WHERE o_orderstatus <> 'F'),
d AS (
  SELECT COALESCE(old.path, new.path) AS path,
    CASE WHEN old.path IS NULL THEN 'new' WHEN new.path IS NULL THEN 'deleted'
         WHEN old.length IS DISTINCT FROM new.length OR old.mtime IS DISTINCT FROM new.mtime
         THEN 'modified' ELSE 'unchanged' END AS change,
    old.length AS old_length, old.mtime AS old_modificationTime,
    new.length AS new_length, new.mtime AS new_modificationTime
  FROM old FULL OUTER JOIN new ON old.path = new.path
)
"""

SQL_DIFF = _SNAP + """
SELECT path, change, round(old_length, 6) AS old_length, old_modificationTime,
       round(new_length, 6) AS new_length, new_modificationTime
FROM d
"""


@register("manifest_diff", SQL_DIFF, "T2 (per-path diff)")
def q_diff(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return rounded(manifest_diff(old, new))


SQL_DIFF_COUNTS = _SNAP + """
SELECT CAST((SELECT count(*) FROM old) AS BIGINT) AS old_total,
  CAST((SELECT count(*) FROM new) AS BIGINT) AS new_total,
  CAST(greatest((SELECT count(*) FROM new) - (SELECT count(*) FROM old), 0) AS BIGINT) AS total_delta_new,
  CAST(greatest((SELECT count(*) FROM old) - (SELECT count(*) FROM new), 0) AS BIGINT) AS total_delta_deleted,
  CAST(count(*) FILTER (WHERE change = 'new') AS BIGINT) AS new_files,
  CAST(count(*) FILTER (WHERE change = 'deleted') AS BIGINT) AS deleted_files,
  CAST(count(*) FILTER (WHERE change = 'modified') AS BIGINT) AS modified_files,
  count(*) FILTER (WHERE change <> 'unchanged') > 0 AS changed
FROM d
"""


@register("manifest_diff_counts", SQL_DIFF_COUNTS, "T2 (summary)")
def q_diff_counts(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return diff_counts(manifest_diff(old, new))


SQL_STATE = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  GROUPING(year(o_orderdate)) = 1 AS is_total,
  CAST(count(*) AS BIGINT) AS files
FROM orders GROUP BY ROLLUP (year(o_orderdate))
"""


@register("manifest_state", SQL_STATE, "T1")
def q_state(spark, sf_dir):
    return rounded(bucket_state(_files(spark, sf_dir)))


def _presence_sql():
    from lapdeck.plans.q_catalog import SQL_PRESENCE
    return SQL_PRESENCE


def _presence(df):
    from lapdeck.operators.catalog import presence_flags
    from lapdeck.plans.q_catalog import EVENT_TYPES
    return presence_flags(df, ["user_id", "day"], "event_type", EVENT_TYPES)


@register("stream_touched", _presence_sql(), "T3 (file stream, touched-partition refresh)")
def q_stream(spark, sf_dir):
    """Land ``events`` in two batches (days before / from the middle of the
    time range), run the refresh stream after each, and return the refreshed
    presence catalog -- it must equal the batch ``catalog_presence``."""
    from pyspark.sql import types as T

    from lapdeck.session import scratch_path
    from lapdeck.streaming.refresh import run_available

    base = scratch_path(spark, "stream-touched")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/_checkpoint"
    ev = (table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
          .withColumn("day", F.to_date("ts")))
    bounds = ev.select(F.min("day").alias("lo"), F.max("day").alias("hi"))
    mid = bounds.select(F.date_add("lo", (F.datediff("hi", "lo") / 2).cast("int"))).scalar()
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("day", T.DateType())])
    for part in (ev.filter(F.col("day") < mid), ev.filter(F.col("day") >= mid)):
        part.write.mode("append").partitionBy("day").parquet(landing)
        run_available(spark, landing=landing, schema=schema, target=target,
                      checkpoint=ckpt, partition_cols=["day"], rebuild=_presence)
    out = spark.read.parquet(target)
    return out.select("user_id", F.col("day").cast("date").alias("day"),
                      *[c for c in out.columns if c.startswith("has_")], "n_present")


SQL_REFRESH_DELETED = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
e AS (SELECT * FROM ev WHERE day <> (SELECT min(day) FROM ev) AND (day <> (SELECT max(day) FROM ev) OR user_id % 2 = 0))
SELECT user_id, day, count(*)::BIGINT AS rows, bool_or(event_type = 'purchase') AS has_purchase FROM e GROUP BY user_id, day
"""


@register("refresh_deleted", SQL_REFRESH_DELETED, "T3 (deleted and changed files)")
def q_refresh_deleted(spark, sf_dir):
    """Land ``events`` by day and refresh; then delete the first day, rewrite the last day with half of its users, and refresh."""
    from pyspark.sql import types as T

    from lapdeck.session import scratch_path
    from lapdeck.sources.sinks import delete_partition
    from lapdeck.streaming.refresh import refresh_changes

    base = scratch_path(spark, "refresh-deleted")
    landing, target, snapshots = f"{base}/landing", f"{base}/target", f"{base}/snapshots"
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("day", T.DateType())])

    def rebuild(df):
        return df.groupBy("user_id", "day").agg(F.count("*").alias("rows"), F.bool_or(F.col("event_type") == "purchase").alias("has_purchase"))

    def refresh():
        refresh_changes(spark, landing, schema, target, ["day"], rebuild, snapshots)

    ev.repartition("day").write.partitionBy("day").parquet(landing)
    refresh()
    lo, hi = ev.agg(F.min("day"), F.max("day")).first()
    delete_partition(spark, landing, day=lo)
    (ev.filter((F.col("day") == F.lit(hi)) & (F.col("user_id") % 2 == 0)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(landing))
    refresh()
    return spark.read.schema("user_id long, rows long, has_purchase boolean, day date").parquet(target)
