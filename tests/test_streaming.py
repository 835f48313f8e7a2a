"""Touched-partition refresh: replaying a micro-batch gives the same table
(what a retried batch after an executor or driver loss does)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapdeck.operators.catalog import presence_flags
from lapdeck.streaming.refresh import refresh_batch, run_available

SCHEMA = T.StructType([T.StructField("user_id", T.LongType()),
                       T.StructField("event_type", T.StringType()),
                       T.StructField("day", T.DateType())])


def _rebuild(df):
    return presence_flags(df, ["user_id", "day"], "event_type", ["click", "view"])


def test_replayed_batch_is_idempotent(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = spark.createDataFrame([(1, "click", d1), (1, "view", d2), (2, "view", d1)], SCHEMA)
    rows.write.partitionBy("day").parquet(landing)
    batch = spark.read.schema(SCHEMA).parquet(landing)
    refresh_batch(spark, batch, landing, SCHEMA, target, ["day"], _rebuild)
    first = sorted(map(tuple, spark.read.parquet(target).collect()))
    refresh_batch(spark, batch, landing, SCHEMA, target, ["day"], _rebuild)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == first
    # a later batch touching only day 2 rewrites day 2 and keeps day 1
    more = spark.createDataFrame([(3, "click", d2)], SCHEMA)
    more.write.mode("append").partitionBy("day").parquet(landing)
    refresh_batch(spark, more, landing, SCHEMA, target, ["day"], _rebuild)
    out = spark.read.parquet(target)
    assert out.filter(F.col("day") == d1).count() == 2
    assert out.filter(F.col("day") == d2).count() == 2


def test_stream_cursor_only_sees_new_files(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / x) for x in ("landing", "target", "ckpt"))
    d1 = dt.date(2024, 1, 1)
    spark.createDataFrame([(1, "click", d1)], SCHEMA).write.partitionBy("day").parquet(landing)
    seen = []

    def rebuild(df):
        seen.append(df.count())
        return _rebuild(df)
    kw = dict(landing=landing, schema=SCHEMA, target=target, checkpoint=ckpt,
              partition_cols=["day"], rebuild=rebuild)
    run_available(spark, **kw)
    run_available(spark, **kw)          # nothing new: no batch runs
    assert seen == [1]
    spark.createDataFrame([(2, "view", d1)], SCHEMA).write.mode("append") \
        .partitionBy("day").parquet(landing)
    run_available(spark, **kw)
    assert seen == [1, 2]               # the touched day is rebuilt from all its rows
    assert spark.read.parquet(target).count() == 2


def test_only_touched_folders_are_read(spark, tmp_path, monkeypatch):
    from lapdeck.streaming import refresh
    landing = str(tmp_path / "landing")
    days = [dt.date(2024, 1, k) for k in range(1, 7)]
    rows = spark.createDataFrame([(k, "click", d) for k, d in enumerate(days)] + [(9, "view", None)], SCHEMA)
    rows.write.partitionBy("day").parquet(landing)
    full = spark.read.schema(SCHEMA).parquet(landing)
    touched = spark.createDataFrame([(days[1],), (days[4],), (None,)], "day date")
    got = refresh.touched_rows(full, touched, ["day"])
    want = sorted(r.user_id for r in got.collect())
    assert want == [1, 4, 9]
    assert "PartitionFilters: [" in (text := got._jdf.queryExecution().executedPlan().toString()) and "PartitionFilters: []" not in text
    monkeypatch.setattr(refresh, "NAMED", 1)
    few = touched.filter("day IS NOT NULL")
    assert sorted(r.user_id for r in refresh.touched_rows(full, few, ["day"]).collect()) == [1, 4]
    assert refresh.touched_rows(full, few.limit(0), ["day"]).collect() == []


def test_catalog_state_writes_touched_sessions_only(spark, tmp_path):
    import os

    from lapdeck.sources.sinks import write_objects
    from lapdeck.streaming.refresh import start_catalog_state
    root, target, ckpt = (str(tmp_path / x) for x in ("landing", "target", "ckpt"))

    def land(kind, *sessions):
        write_objects(spark.createDataFrame([(*s, 1) for s in sessions], "year int, event string, session string, x int"), root, kind)
        start_catalog_state(spark, root, target, ckpt).awaitTermination()

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(target) for f in names if f.startswith("part-")}

    a, b = (2024, "a_gp", "Race"), (2024, "b+ gp", "Practice 1")
    land("results", a, b)
    first = files()
    land("laps", a)
    land("session_info", a)
    rows = {tuple(r[c] for c in ("year", "event", "session")): r for r in spark.read.parquet(target).collect()}
    assert rows.keys() == {a, b} and rows[a].is_complete and rows[a].files == 3 and not rows[b].has_laps and rows[b].has_results
    left = {f: t for f, t in files().items() if "session=Practice 1" in f}
    assert left and left == {f: t for f, t in first.items() if "session=Practice 1" in f}
    again = files()
    start_catalog_state(spark, root, target, ckpt).awaitTermination()  # nothing new
    assert files() == again
