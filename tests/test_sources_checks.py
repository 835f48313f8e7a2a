"""Sources (gated scan, fan-in, manifest), sinks, checks, change detection."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapdeck.functions.columns import event_key, normalise_missing
from lapdeck.operators import checks as K
from lapdeck.operators.changes import bucket_state, diff_counts, manifest_diff
from lapdeck.sources import readers as R
from lapdeck.sources.landed import read_landed
from lapdeck.sources import sinks as S
from lapdeck.sources.manifest import child_prefixes, ingest_summary, manifest


def test_key_rule(spark):
    df = spark.createDataFrame([("Italian Grand Prix",), ("São Paulo Grand Prix",)], "e string")
    assert [r.k for r in df.select(event_key("e").alias("k")).collect()] == \
        ["italian_grand_prix", "são_paulo_grand_prix"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    out = normalise_missing(df).agg(F.avg("a"), F.count("a")).first()
    assert out[0] == 2.0 and out[1] == 1


def test_sinks_and_gated_scan(spark, tmp_path):
    root = str(tmp_path / "raw")
    laps = spark.createDataFrame(
        [(2022, "Italian Grand Prix", "Race", 1.0, 90.0), (2022, "Italian Grand Prix", "Race", 2.0, float("nan")),
         (2022, "Belgian Grand Prix", "Race", 1.0, 100.0)],
        "y int, EventName string, SessionName string, LapNumber double, LapTimeSeconds double")
    keyed = S.with_session_keys(laps, "y")
    written = S.write_sessions({"laps": keyed, "weather": None,
                                "results": keyed.limit(0)}, root)
    assert written == {"laps": True, "weather": False, "results": False}
    back = R.read_sessions(spark, root, "laps")
    assert back.filter(F.col("event") == "italian_grand_prix").count() == 2
    assert back.filter(F.col("LapTimeSeconds").isNull()).count() == 1  # NaN normalised
    # dynamic overwrite replaces only the touched session
    again = keyed.filter(F.col("event") == "belgian_grand_prix").withColumn("LapNumber", F.lit(9.0))
    S.write_sessions({"laps": again}, root)
    back = R.read_sessions(spark, root, "laps")
    assert back.count() == 3 and back.filter(F.col("LapNumber") == 9.0).count() == 1
    assert S.delete_partition(spark, f"{root}/data_type=laps", year=2022, event="belgian_grand_prix")
    assert R.read_sessions(spark, root, "laps").count() == 2

    # footer facts + gate over the landed files
    files = manifest(spark, root)
    facts = R.gate_files(R.file_facts(files), ["LapNumber", "LapTimeSeconds", "Compound"])
    reasons = {r.reason for r in facts.collect()}
    assert reasons == {"missing columns"}
    ok = R.gate_files(R.file_facts(files), ["LapNumber"])
    schema = T.StructType([T.StructField("LapNumber", T.DoubleType())])
    assert R.read_gated(spark, ok, schema, f"{root}/data_type=laps").count() == 2
    # a gate that rejects everything keeps no rows
    assert R.read_gated(spark, facts, schema, f"{root}/data_type=laps").count() == 0
    missing = spark.createDataFrame([(f"{root}/nope.parquet",)], "path string")
    assert R.gate_files(R.file_facts(missing), ["x"]).first().reason == "missing"
    assert child_prefixes(files).count() == 1


def test_fan_in_reference_layout_and_empty_gate(spark, tmp_path):
    base = str(tmp_path / "ref")
    for ev, n in (("monza", 2), ("spa", 1)):
        spark.range(n).withColumn("LapNumber", F.col("id").cast("double")).drop("id") \
            .coalesce(1).write.parquet(f"{base}/2022/{ev}/Race/laps.parquet")
    spark.range(0).withColumn("LapNumber", F.col("id").cast("double")).drop("id") \
        .coalesce(1).write.parquet(f"{base}/2022/empty/Race/laps.parquet")
    df = read_landed(spark, base, "laps", required=["LapNumber"])
    got = {(r.event, r.session): r["count"] for r in df.groupBy("event", "session").count().collect()}
    assert got == {("monza", "Race"): 2, ("spa", "Race"): 1}
    files = spark.createDataFrame(
        [(os.path.join(dp, f),) for dp, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")],
        "path string")
    facts = R.gate_files(R.file_facts(files), ["LapNumber"]).collect()
    assert sorted({r.reason for r in facts if not r.ok}) == ["empty"]


def test_parquet_codecs_and_csv(spark, tmp_path):
    df = spark.range(20000).select(F.lit("constant text value").alias("s"), "id").coalesce(1)
    assert S.write_parquet(df, str(tmp_path / "snappy"), "snappy")
    assert S.write_parquet(df, str(tmp_path / "none"), "none")
    size = lambda p: sum(os.path.getsize(os.path.join(p, f)) for f in os.listdir(p))
    assert size(str(tmp_path / "snappy")) <= size(str(tmp_path / "none"))
    assert not S.write_parquet(df.limit(0), str(tmp_path / "empty"))
    iv = spark.sql("SELECT INTERVAL '0 01:20:27.511' DAY TO SECOND AS t, array('a','b') AS xs")
    assert S.write_csv(iv, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv")).first()
    assert float(back.t) == pytest.approx(4827.511) and back.xs == "a,b"
    assert S.write_sample(spark.range(500), str(tmp_path / "sample"), ["id"], 100)
    assert spark.read.option("header", True).csv(str(tmp_path / "sample")).count() == 100


def test_ingest_summary_counts_all_types(spark):
    files = spark.createDataFrame(
        [(t, "2022", 1048576) for t in ("results", "laps", "weather", "session_info", "track_status",
                                        "session_status", "race_control_messages")]
        + [("season_schedule", "2022", 0), ("laps", "2023", 1048576)],
        "data_type string, year_part string, length long")
    out = {(r.level, r.data_type, r.year_part): r for r in ingest_summary(files).collect()}
    assert out[("total", None, None)].objects == 9 and out[("total", None, None)].size_mb == 8.0
    assert out[("data_type", "laps", None)].objects == 2
    assert out[("year", None, "2022")].objects == 8


def test_checks_one_table(spark):
    df = spark.createDataFrame([(1, 5.0), (1, float("nan")), (2, 200.0), (3, None)], "k int, x double")
    res = {r.check: r for r in K.run_checks(df, [
        K.rowcount("rows", 15, 25), K.duplicates("dups", ["k"]), K.required("req", ["k", "y"]),
        K.nulls("nulls_x", "x", 0.3), K.in_range("range_x", "x", 0, 100),
        K.nulls("nulls_z", "z", 0.1)]).collect()}
    assert res["rows"].measured == 4 and not res["rows"].ok
    assert res["dups"].measured == 2 and not res["dups"].ok
    assert res["req"].measured == 1 and not res["req"].ok
    assert res["nulls_x"].measured == 0.5 and not res["nulls_x"].ok
    assert res["range_x"].measured == 1
    assert not res["nulls_z"].ok
    with pytest.raises(ValueError):
        K.assert_checks(K.run_checks(df, [K.duplicates("dups", ["k"])]))


def test_manifest_diff_and_state(spark):
    t = dt.datetime(2022, 1, 1)
    old = spark.createDataFrame([("2022/a", 1, t), ("2022/b", 2, t), ("2021/c", 3, t), ("x/d", 1, t)],
                                "path string, length long, modificationTime timestamp")
    new = spark.createDataFrame([("2022/a", 1, t), ("2022/b", 5, t), ("2023/e", 1, t), ("x/d", 1, t)],
                                "path string, length long, modificationTime timestamp")
    d = {r.path: r.change for r in manifest_diff(old, new).collect()}
    assert d == {"2022/a": "unchanged", "2022/b": "modified", "2021/c": "deleted",
                 "2023/e": "new", "x/d": "unchanged"}
    c = diff_counts(manifest_diff(old, new)).first()
    assert (c.total_delta_new, c.new_files, c.deleted_files, c.modified_files, c.changed) == \
        (0, 1, 1, 1, True)
    st = {r.year: r.files for r in bucket_state(
        old.withColumn("year_part", F.split("path", "/")[0])).collect()}
    assert st == {2022: 2, 2021: 1, None: 4}


def test_dataset_gate(spark):
    df = spark.createDataFrame([(1, "a")], "RoundNumber int, EventName string")
    assert R.dataset_gate(spark, None, ["x"]).first().reason == "missing"
    g = R.dataset_gate(spark, df, ["RoundNumber", "Session1"]).first()
    assert (g.ok, g.reason, g.missing_columns) == (False, "missing columns", ["Session1"])
    assert R.dataset_gate(spark, df.limit(0), ["RoundNumber"]).first().reason == "empty"
    g = R.dataset_gate(spark, df, ["RoundNumber"]).first()
    assert g.ok and g.rows == 1


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 2).alias("year"), "id")
    plan = df.hint("rebalance", "year")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert S.write_parquet(df, str(tmp_path / "p"), partition_by=("year",))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000


def test_session_rewrite_is_dynamic_even_if_session_says_static(spark, tmp_path):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        df = spark.createDataFrame([(2022, "a", "Race", 1), (2022, "b", "Race", 2)],
                                   "year int, event string, session string, v int")
        root = str(tmp_path / "dyn")
        S.write_sessions({"t": df}, root)
        S.write_sessions({"t": df.filter("event = 'b'").withColumn("v", F.lit(9))}, root)
        got = sorted((r.event, r.v) for r in R.read_sessions(spark, root, "t").collect())
        assert got == [("a", 1), ("b", 9)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
