"""Objects as pandas writes them: nanosecond timestamps, durations, names with spaces, broken files."""

import os

import numpy as np
import pandas as pd
import pytest

from lapdeck.plans import motorsport as M
from lapdeck.sources.landed import landed_gate, read_landed

DRIVERS = ["1", "11", "16", "44"]


def put(root, year, event, session, kind, frame, **how):
    folder = os.path.join(root, str(year), event, session)
    os.makedirs(folder, exist_ok=True)
    frame.to_parquet(os.path.join(folder, f"{kind}.parquet"), **how)


@pytest.fixture(scope="module")
def bucket(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pandas"))
    seconds = pd.to_timedelta
    for year, rnd in ((2024, 1), (2031, 2)):
        for session in ("Practice 1", "Sprint Qualifying", "Qualifying", "Race"):
            date = pd.Timestamp(f"{year}-03-0{rnd} 15:00:00.123456789")
            put(root, year, "some_prix", session, "session_info", pd.DataFrame(
                [dict(event_name="Some Prix", location="X", country="Y", session_name=session, session_date=date, total_laps=57,
                      event_format="conventional", round_number=rnd, official_event_name="O")]))
            put(root, year, "some_prix", session, "results", pd.DataFrame({
                "DriverNumber": DRIVERS, "Abbreviation": ["AAA", "BBB", "CCC", "DDD"], "DriverId": ["a", "b", "c", "d"],
                "Position": [1.0, 2.0, 3.0, np.nan], "GridPosition": [2.0, 1.0, 3.0, 4.0], "Status": ["Finished"] * 3 + ["Engine"],
                "Points": [25.0, 18.0, 15.0, 0.0], "Q1": seconds([80.5, 81.0, np.nan, 82.25], unit="s"), "Q2": seconds([np.nan] * 4, unit="s"),
                "Q3": seconds([np.nan] * 4, unit="s"), "Time": seconds([5000.25, 1.5, 2.5, np.nan], unit="s")}))
            n = 12
            put(root, year, "some_prix", session, "laps", pd.DataFrame({
                "DriverNumber": np.repeat(DRIVERS, n), "Driver": np.repeat(["AAA", "BBB", "CCC", "DDD"], n), "Team": "T",
                "LapNumber": np.tile(np.arange(1.0, n + 1), 4), "Time": seconds(np.arange(4.0 * n) * 90, unit="s"),
                "LapTime": seconds(90 + np.arange(4 * n) % 5 / 10, unit="s"), "Sector1Time": seconds([30.25] * 4 * n, unit="s"),
                "Sector2Time": seconds([31.0] * 4 * n, unit="s"), "Sector3Time": seconds([29.0] * 4 * n, unit="s"), "TrackStatus": "1",
                "Deleted": [None, False] * 2 * n, "Stint": 1.0, "Position": 1.0}))
    put(root, 2024, "other_prix", "Race", "session_info", pd.DataFrame([dict(session_date="2024-05-01", round_number=7.0)]))
    put(root, 2024, "other_prix", "Race", "laps", pd.DataFrame({"DriverNumber": [1], "LapNumber": [1]}))
    with open(os.path.join(root, "2024", "other_prix", "Race", "results.parquet"), "wb") as f:
        f.write(b"not parquet")
    put(root, 2024, "third_prix", "Race", "results", pd.DataFrame({"DriverNumber": ["1"]}))
    put(root, 2024, "fourth_prix", "Race", "results", pd.DataFrame({"DriverNumber": [], "Position": [], "Status": []}))
    put(root, 2024, "fifth+50%_prix", "Race", "results", pd.DataFrame({"DriverNumber": [5], "Position": ["2"], "Status": ["Finished"], "Q1": ["0 days 00:01:20.500000"], "extra": [1]}),
        coerce_timestamps="us")
    return root


def test_rows_types_and_units(spark, bucket):
    rows = read_landed(spark, bucket, "results").collect()
    assert len(rows) == 2 * 4 * 4 + 1 and {r.session for r in rows} == {"Practice 1", "Sprint Qualifying", "Qualifying", "Race"}
    q = {(r.DriverNumber, r.Q1, r.Position) for r in rows if (r.year, r.session) == (2031, "Qualifying")}
    assert q == {("1", 80.5, 1.0), ("11", 81.0, 2.0), ("16", None, 3.0), ("44", 82.25, None)}
    odd = next(r for r in rows if r.event == "fifth+50%_prix")
    assert (odd.DriverNumber, odd.Position, odd.Q1, odd.Points) == ("5", 2.0, 80.5, None)
    info = {(r.year, r.event, r.session): r for r in read_landed(spark, bucket, "session_info").collect()}
    assert str(info[(2024, "some_prix", "Practice 1")].session_date) == "2024-03-01 15:00:00.123456"
    assert info[(2024, "other_prix", "Race")].round_number == 7 and str(info[(2024, "other_prix", "Race")].session_date) == "2024-05-01 00:00:00"


def test_gate_says_why(spark, bucket):
    gate = {r.event: r for r in landed_gate(spark, bucket, "results").collect() if not r.ok}
    assert {k: r.reason for k, r in gate.items()} == {"other_prix": "unreadable", "third_prix": "missing columns", "fourth_prix": "empty"}
    assert gate["third_prix"].missing_columns == ["Position", "Status"]


def test_jobs_on_these_files(spark, bucket, tmp_path):
    cat = M.catalog_job(spark, bucket, out=str(tmp_path / "cat"))
    assert cat.data.columns[:22] == ["year", "round", "event_name", "circuit", "session", "session_date", "session_path", "has_results", "has_laps",
                                     "has_weather", "has_session_info", "has_track_status", "has_session_status", "has_race_control",
                                     "total_drivers", "total_laps", "event_format", "has_qualifying_data", "has_null_positions",
                                     "has_null_grid", "is_complete", "completeness_score"]
    rows = {(r.year, r.event_name, r.session): r for r in cat.data.collect()}
    assert (2031, "some_prix", "Race") in rows  # no built-in last year
    p1 = rows[(2024, "some_prix", "Practice 1")]
    assert (p1.round, p1.circuit, p1.race_id, p1.total_drivers, p1.session_path) == (1, "X", "2024_R01", 4, "2024/some_prix/Practice 1/")
    res = M.race_results_job(spark, bucket, cat.data)
    got = {(r.race_id, r.driver_number): r for r in res.data.collect()}
    assert got[("2024_R01", "1")].q1_seconds == 80.5 and got[("2031_R02", "1")].race_time_seconds == 5000.25
    assert {(r.race_id, r.reason) for r in res.skips.collect()} == {("2024_R07", "unreadable")}
    laps = M.lap_features_job(spark, bucket, cat.data)
    feats = {(r.race_id, r.driver_number): r for r in laps.data.collect()}
    assert feats[("2024_R01", "1")].driver_abbreviation == "AAA" and abs(feats[("2024_R01", "1")].avg_lap_time - 90.2) < 0.2
    assert 30 < feats[("2024_R01", "1")].avg_sector1 < 30.5
    assert {(r.race_id, r.reason) for r in laps.skips.collect()} == {("2024_R07", "no valid laps")}
    assert M.catalog_job(spark, bucket, last_year=2030).data.filter("year = 2031").isEmpty()


def test_empty_bucket(spark, tmp_path):
    root = str(tmp_path / "empty")
    os.makedirs(root)
    cat = M.catalog_job(spark, root)
    assert cat.data.collect() == [] and cat.checks.first().validation_passed
    assert M.race_results_job(spark, root, cat.data).data.collect() == []
    assert M.lap_features_job(spark, root, cat.data).data.collect() == []


VARIANTS = {
    "text": pd.DataFrame({"DriverNumber": ["1", "2", None], "Position": ["1", "x", None], "Status": ["a", None, "c"], "Points": ["1.5", "inf", ""],
                          "Q1": ["0 days 00:01:20.500000", "01:20:27.5", None], "Q2": ["-1 days +23:59:58.500000", "2 days", "junk"], "Laps": ["7", "8.0", "9"]}),
    "numbers": pd.DataFrame({"DriverNumber": [1, 2, 44], "Position": np.array([1, 2, 3], "int8"), "Status": [1.0, 2.5, np.nan],
                             "Points": np.array([1.5, np.nan, 3], "float32"), "Q1": [80.5, np.nan, 0.0], "Q2": [80_500_000_000, 1, 0], "Laps": np.array([1, 2, 3], "uint32")}),
    "durations": pd.DataFrame({"DriverNumber": pd.Categorical(["1", "2", "1"]), "Position": [1.0, np.nan, 3.0], "Status": [True, False, True],
                               "Points": [None, None, None], "Q1": pd.to_timedelta([80.5, np.nan, 1e-6], unit="s"),
                               "Q2": pd.to_timedelta([80.5, np.nan, -1.5], unit="s").astype("timedelta64[ms]"), "Laps": [True, False, True]}),
}
def _times(values):
    return pd.to_datetime(values, format="ISO8601")


STAMPS = {
    "ns": _times(["2024-03-01 15:00:00.123456789", None, "1969-12-31 23:59:59.999999999"]), "us": _times(["2024-03-01 15:00:00.123456", None, "1960-01-01"]).astype("datetime64[us]"),
    "ms": _times(["2024-03-01 15:00:00.123", None, "1960-01-01"]).astype("datetime64[ms]"), "zone": _times(["2024-03-01 15:00:00", None, "1960-01-01"]).tz_localize("Europe/Rome"),
    "zone_us": _times(["2024-03-01 15:00:00", None, "1960-01-01"]).tz_localize("Europe/Rome").astype("datetime64[us, Europe/Rome]"),
    "text": ["2024-03-01 15:00:00.25", None, "2024-03-01 16:00:00.50"],
    "text_zone": ["2024-03-01T15:00:00+02:00", None, "2024-03-01T16:00:00+01:00"], "count": [1_709_305_200_123_456_789, 0, -1], "date": [pd.Timestamp("2024-03-01").date(), None, pd.Timestamp("1960-01-01").date()],
}


@pytest.fixture(scope="module")
def variants(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("variants"))
    for k, (name, frame) in enumerate(VARIANTS.items()):
        put(root, 2020 + k, f"{name} [a*]", "Race", "results", frame)
    for name, stamps in STAMPS.items():
        put(root, 2024, name, "Race", "session_info", pd.DataFrame({"session_date": stamps, "round_number": [1, 2.0, np.nan], "event_name": [1, 2, 3]}))
    put(root, 2024, "int96", "Race", "session_info", pd.DataFrame({"session_date": STAMPS["us"], "round_number": ["3", "4.5", ""]}), use_deprecated_int96_timestamps=True)
    return root


@pytest.mark.parametrize("kind", ["results", "session_info"])
def test_expressions_equal_the_decoder(spark, variants, kind):
    from lapdeck.sources.landed import _as_path, _decoded, landed_footers
    native = read_landed(spark, variants, kind)
    assert "MapInArrow" not in native._jdf.queryExecution().executedPlan().toString()
    paths = [_as_path(r.path) for r in landed_footers(spark, variants, kind).collect()]
    assert paths and "[" in "".join(paths) or kind != "results"
    want = _decoded(spark, kind, [r.path for r in landed_footers(spark, variants, kind).collect()])
    key = lambda r: str(tuple(r))
    assert sorted(native.collect(), key=key) == sorted(want.collect(), key=key)


def test_nested_columns_are_decoded(spark, tmp_path):
    root = str(tmp_path)
    put(root, 2024, "a", "Race", "results", pd.DataFrame({"DriverNumber": ["1"], "Position": [1.0], "Status": [["x"]]}))
    put(root, 2024, "b", "Race", "results", pd.DataFrame({"DriverNumber": ["2"], "Position": [2.0], "Status": ["y"]}))
    got = {r.event: r.Position for r in read_landed(spark, root, "results").collect()}
    assert got == {"a": 1.0, "b": 2.0}


def test_scans_are_pruned(spark, bucket):
    rows = read_landed(spark, bucket, "results").filter("year = 2031").select("Position")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    text = plan.toString()
    schemas = [x.split(">")[0] for x in text.split("ReadSchema: struct<")[1:]]
    assert schemas and set(schemas) <= {"Position:double", "Position:string"} and "MapInArrow" not in text and "PythonUDF" not in text
    assert "file_path" in text.split("DataFilters: [")[1].split("]")[0]
    files, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            files += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert files == 4  # of the nine usable objects, those of 2031


def test_keys_take_no_pattern_per_row(spark, bucket):
    keys = read_landed(spark, bucket, "results").select("year", "event", "session").distinct()
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert "file_path" in plan and "regexp" not in plan
    assert (2024, "fifth+50%_prix", "Race") in {tuple(r) for r in keys.collect()}


def test_keys_of_odd_paths(spark):
    from pyspark.sql import functions as F

    from lapdeck.sources.landed import _keys_of
    none = (None, "", "")
    want = {"file:/r/1995/round 1/Race/results.parquet": (1995, "round 1", "Race"), "s3a://b/results.parquet/1995/e/s/results.parquet/p": (1995, "e", "s"),
            "/a/1995/e/s/results.parquet/results.parquet": (1995, "e", "s"), "/r/x/e/s/results.parquet": (None, "e", "s"),
            "/r/1995/e/s/results.parquet/a=1/p": none, "/r/1995/e/s/xresults.parquet": none, "/r/1995/e/s/laps.parquet": none}
    paths = spark.createDataFrame([(p,) for p in want], "p string")
    assert {r.p: tuple(r)[1:] for r in paths.select("p", *_keys_of(F.col("p"), "results")).collect()} == want
    season = spark.createDataFrame([("/r/1995/circuits.parquet",), ("/r/1996/circuits.parquet/p",), ("/r/1997/xcircuits.parquet",)], "p string")
    assert [tuple(r) for r in season.select(*_keys_of(F.col("p"), "circuits")).collect()] == [(1995, None, None), (1996, None, None), (None, None, None)]
