"""Catalog over a manifest: presence, completeness, metadata, quality,
derived columns, flags, verdict, issues and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapdeck.operators import catalog as C

ROOT = "s3a://bucket/raw"


def _manifest(spark):
    paths = []
    # complete race + qualifying for round 16, incomplete race for round 14 (no
    # laps), practice with 2 files, season-level files, a bad year, an unknown session
    for t in C.DATA_TYPES:
        paths.append(f"2022/italian_grand_prix/Race/{t}.parquet")
        paths.append(f"2022/italian_grand_prix/Qualifying/{t}.parquet")
    for t in ("results", "session_info", "weather"):
        paths.append(f"2022/belgian_grand_prix/Race/{t}.parquet")
    paths += ["2022/belgian_grand_prix/Practice 1/results.parquet",
              "2022/belgian_grand_prix/Practice 1/laps.parquet",
              "2022/season_schedule.parquet", "2022/circuits.parquet",
              "1999/x/Race/results.parquet", "2022/italian_grand_prix/Warmup/results.parquet"]
    rows = [(f"{ROOT}/{p}", 1024 * (i + 1), dt.datetime(2022, 10, 1)) for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")


def _session_info(spark):
    rows = [(2022, "italian_grand_prix", s, "Italian Grand Prix", "Monza", dt.datetime(2022, 9, d, 13),
             53, "conventional", 16) for s, d in (("Race", 11), ("Qualifying", 10))]
    rows += [(2022, "belgian_grand_prix", s, "Belgian Grand Prix", "Spa", dt.datetime(2022, 8, d, 13),
              44, "conventional", 14) for s, d in (("Race", 28), ("Practice 1", 26))]
    return spark.createDataFrame(rows, "year int, event string, session string, event_name string, "
                                 "location string, session_date timestamp_ntz, total_laps int, "
                                 "event_format string, round_number int")


def _results(spark):
    rows = [(2022, "italian_grand_prix", "Race", "1", 1.0, 7.0),
            (2022, "italian_grand_prix", "Race", "44", None, 19.0),
            (2022, "belgian_grand_prix", "Race", "1", 1.0, 14.0)]
    return spark.createDataFrame(rows, "year int, event string, session string, DriverNumber string, "
                                 "Position double, GridPosition double")


@pytest.fixture(scope="module")
def catalog(spark):
    files = C.parse_manifest(_manifest(spark), ROOT)
    return C.build_catalog(files, _session_info(spark), _results(spark)).cache()


def test_parse_and_discovery(spark):
    files = C.parse_manifest(_manifest(spark), ROOT)
    assert [r.year for r in C.discover_years(files).collect()] == [2022]
    sess = C.session_files(files)
    assert sess.filter(F.col("session") == "Warmup").count() == 0
    assert sess.filter(F.col("event").isNull()).count() == 0


def test_catalog_rows(catalog):
    rows = {(r.event, r.session): r for r in catalog.collect()}
    assert set(rows) == {("italian_grand_prix", "Race"), ("italian_grand_prix", "Qualifying"),
                         ("belgian_grand_prix", "Race"), ("belgian_grand_prix", "Practice 1")}
    it = rows[("italian_grand_prix", "Race")]
    assert it.is_complete and it.completeness_score == 100.0 and it.race_id == "2022_R16"
    assert it.total_drivers == 2 and it.has_null_positions and not it.has_null_grid
    assert it.has_qualifying_data and it.circuit == "Monza" and it.total_laps == 53
    be = rows[("belgian_grand_prix", "Race")]
    assert not be.is_complete and be.completeness_score == pytest.approx(300 / 7)
    assert not be.has_qualifying_data and be.days_since_start == 2  # from practice, 26 Aug
    assert it.days_since_start == 16
    # season progress within 2022: rounds 14..16
    assert be.season_progress == 0.0 and it.season_progress == 1.0
    p1 = rows[("belgian_grand_prix", "Practice 1")]
    assert p1.total_drivers is None and p1.has_null_positions is False


def test_validation_flags_and_verdict(catalog):
    v, verdict = C.validate_catalog(catalog, as_of="2022-12-31 00:00:00")
    rows = {(r.event, r.session): r for r in v.collect()}
    be = rows[("belgian_grand_prix", "Race")]
    assert be.validation_warnings == "Missing qualifying session; Missing files: laps; "
    it = rows[("italian_grand_prix", "Race")]
    assert it.validation_warnings == "Contains null positions (may be DNFs); "
    vr = verdict.first()
    # warnings: missing qualifying, incomplete race, stale latest race -> 3 kinds
    assert vr.validation_passed and vr.total_errors == 0 and vr.total_warnings == 3
    assert vr.data_quality_score == round(100 * (1 - 0.3 / 4), 2)


def test_duplicates_flag_every_copy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    out = C.flag_duplicates(df, ["k"]).collect()
    flags = sorted((r.k, r.validation_passed, r.validation_errors) for r in out)
    assert flags == [(1, False, "Duplicate entry; "), (1, False, "Duplicate entry; "), (2, True, "")]


def test_missing_partner_flags_first_row_only(spark):
    df = spark.createDataFrame([(1, 2022, "Race", "a"), (2, 2022, "Race", "b"),
                                (3, 2023, "Race", "c"), (4, 2023, "Qualifying", "d")],
                               "id int, year int, session string, event string")
    out = C.flag_missing_partner(df, ["year"], "session", "Race", "Qualifying", ["event"], "M; ")
    got = {r.id: r.validation_warnings for r in out.collect()}
    assert got == {1: "M; ", 2: "", 3: "", 4: ""}


def test_issues_and_reports(catalog):
    issues = {r.issue: r["count"] for r in C.catalog_issues(catalog).collect()}
    assert issues == {"no_races": 0, "incomplete_races": 1, "races_missing_qualifying": 1,
                      "sessions_with_null_positions": 1}
    det = {(r.issue, r.event) for r in C.catalog_issue_details(catalog).collect()}
    assert ("incomplete_races", "belgian_grand_prix") in det
    assert ("sessions_with_null_positions", "italian_grand_prix") in det
    r = {(x.year, x.is_total): x for x in
         C.rollup_summary(catalog, "year", F.col("is_complete"), F.col("completeness_score")).collect()}
    assert r[(2022, False)].entries == 4 and r[(None, True)].complete == 2
    b = C.breakdown(catalog, ["year", "session"], F.col("is_complete")).collect()
    assert b[0].session == "Race" and b[0].total == 2


def test_empty_catalog_flows(spark, catalog):
    empty = catalog.limit(0)
    v, verdict = C.validate_catalog(empty)
    assert v.count() == 0
    vr = verdict.first()
    assert vr.validation_passed and vr.data_quality_score == 100.0
    issues = {r.issue: r["count"] for r in C.catalog_issues(empty).collect()}
    assert issues["no_races"] == 1


def test_race_id_null_round_only_that_row(spark):
    df = spark.createDataFrame([(2022, 3), (2022, None), (2022, 123)], "year int, round int")
    assert [r.race_id for r in C.add_race_id(df).collect()] == ["2022_R03", None, "2022_R123"]


def test_days_since_start_counts_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1, 12),), (dt.datetime(2022, 1, 2, 10),),
                                (dt.datetime(2022, 1, 3, 12),)], "session_date timestamp_ntz")
    assert [r.days_since_start for r in C.add_days_since_start(df).collect()] == [0, 0, 2]
