"""Validation rule sets on fixture rows (the reference's accept / reject
cases) and the generic operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapdeck.functions import domains as D
from lapdeck.operators import validation as v

RESULT_SCHEMA = (
    "DriverNumber string, BroadcastName string, Abbreviation string, DriverId string, "
    "TeamName string, TeamColor string, TeamId string, FirstName string, LastName string, "
    "FullName string, HeadshotUrl string, CountryCode string, Position double, "
    "ClassifiedPosition string, GridPosition double, Q1 double, Q2 double, Q3 double, "
    "Time double, Status string, Points double, Laps double, EventName string, "
    "SessionName string, SessionDate timestamp_ntz")


def _result(**over):
    base = dict(DriverNumber="1", BroadcastName="M VERSTAPPEN", Abbreviation="ver",
                DriverId="max_verstappen", TeamName="Red Bull Racing", TeamColor="1e5bc6",
                TeamId="red_bull", FirstName="Max", LastName="Verstappen",
                FullName="Max Verstappen", HeadshotUrl="u", CountryCode="NED", Position=1.0,
                ClassifiedPosition="1", GridPosition=1.0, Q1=None, Q2=None, Q3=None,
                Time=5000.0, Status="Finished", Points=25.0, Laps=53.0,
                EventName="Italian Grand Prix", SessionName="Race",
                SessionDate=dt.datetime(2022, 9, 11, 13))
    base.update(over)
    return base


def _df(spark, rows, schema=RESULT_SCHEMA):
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_race_results_accept_and_reject(spark):
    rows = [_result(), _result(DriverNumber="16", Position=25.0),
            _result(DriverNumber="ABC"), _result(DriverNumber="44", Time=None, Status="Engine"),
            _result(DriverNumber="55", GridPosition=25.0)]
    valid, invalid = v.split_valid(_df(spark, rows), D.RACE_RESULT_RULES)
    assert sorted(r.DriverNumber for r in valid.collect()) == ["1", "44"]
    errs = {r.DriverNumber: r.errors for r in invalid.collect()}
    assert any("ABC" in e for e in errs["ABC"])
    assert any("Position" in e for e in errs["16"])
    assert any("GridPosition" in e for e in errs["55"])


def test_four_of_five_valid_summary_and_errors(spark):
    rows = [_result(DriverNumber=str(n)) for n in (1, 11, 16, 55)] + [_result(DriverNumber="ABC")]
    vd = v.validate(_df(spark, rows), D.RACE_RESULT_RULES)
    s = v.summary(vd).first()
    assert (s.total_rows, s.valid_rows, s.invalid_rows) == (5, 4, 1)
    assert s.validation_rate == pytest.approx(80.0)
    first = [r.error for r in v.first_errors(vd, ["DriverNumber"]).collect()]
    assert len(first) == 1 and "ABC" in first[0]
    with pytest.raises(ValueError, match="1 errors"):
        v.fail_fast(vd, ["DriverNumber"])


def test_empty_input_gives_empty_output(spark):
    empty = _df(spark, [])
    valid, invalid = v.split_valid(empty, D.RACE_RESULT_RULES)
    assert valid.count() == 0 and invalid.count() == 0
    s = v.summary(v.validate(empty, D.RACE_RESULT_RULES)).first()
    assert (s.total_rows, s.validation_rate) == (0, 0.0)


def test_all_valid_summary_is_100(spark):
    s = v.summary(v.validate(_df(spark, [_result()]), D.RACE_RESULT_RULES)).first()
    assert s.validation_rate == 100.0


def test_abbreviation_and_compound_normalised(spark):
    df = spark.createDataFrame([("ver", "soft"), ("lec", "hyper")], "Abbreviation string, Compound string")
    out = v.normalise_values(df, ["Abbreviation"], {"Compound": D.COMPOUNDS}).collect()
    assert [(r.Abbreviation, r.Compound) for r in out] == [("VER", "SOFT"), ("LEC", "hyper")]


LAP_SCHEMA = ("Time double, LapTime double, LapNumber double, LapStartTime double, "
              "Driver string, DriverNumber string, Team string, Stint double, "
              "IsPersonalBest boolean, Deleted boolean, FastF1Generated boolean, "
              "IsAccurate boolean, Compound string, TyreLife double, TrackStatus string, "
              "LapTimeSeconds double, EventName string, SessionName string, "
              "SessionDate timestamp_ntz")


def _lap(**over):
    base = dict(Time=1.0, LapTime=90.0, LapNumber=1.0, LapStartTime=0.0, Driver="VER",
                DriverNumber="1", Team="Red Bull", Stint=1.0, IsPersonalBest=False,
                Deleted=False, FastF1Generated=False, IsAccurate=True, Compound="soft",
                TyreLife=3.0, TrackStatus="1", LapTimeSeconds=90.0, EventName="E",
                SessionName="Race", SessionDate=dt.datetime(2022, 9, 11))
    base.update(over)
    return base


def test_lap_rules(spark):
    rows = [_lap(), _lap(LapNumber=0.0), _lap(TyreLife=62.0), _lap(TyreLife=2.5),
            _lap(LapTimeSeconds=400.0), _lap(Compound="hyper")]
    vd = v.validate(_df(spark, rows, LAP_SCHEMA), D.LAP_RULES).collect()
    errs = [len(r.errors) for r in vd]
    warns = [len(r.warnings) for r in vd]
    assert errs == [0, 1, 1, 1, 0, 0]
    assert warns[0] == 0 and warns[4] == 1 and warns[5] == 1  # soft compound accepted


WEATHER_SCHEMA = ("Time double, AirTemp double, Humidity double, Pressure double, "
                  "Rainfall boolean, TrackTemp double, WindDirection int, WindSpeed double, "
                  "EventName string, SessionName string, SessionDate timestamp_ntz")


def test_weather_rules_hard_and_soft(spark):
    base = dict(Time=1.0, AirTemp=28.0, Humidity=40.0, Pressure=1010.0, Rainfall=False,
                TrackTemp=44.0, WindDirection=200, WindSpeed=2.0, EventName="E",
                SessionName="Race", SessionDate=dt.datetime(2022, 9, 11))
    rows = [base, {**base, "AirTemp": 100.0}, {**base, "Humidity": 150.0},
            {**base, "TrackTemp": 20.0}, {**base, "AirTemp": -5.0},
            {**base, "WindSpeed": 80.0}]
    vd = v.validate(_df(spark, rows, WEATHER_SCHEMA), D.WEATHER_RULES).collect()
    assert [len(r.errors) for r in vd] == [0, 1, 1, 0, 0, 0]
    assert "TrackTemp below AirTemp - 5: 20.0" in vd[3].warnings
    assert any("AirTemp unusual" in w for w in vd[4].warnings)
    # wind speed is only enforced when the optional rule is added
    vd2 = v.validate(_df(spark, rows[-1:], WEATHER_SCHEMA),
                     D.WEATHER_RULES + [D.WIND_SPEED_RULE]).first()
    assert len(vd2.errors) == 1


def test_session_dispatch_skips_absent_and_picks_rule_set(spark):
    quali = _df(spark, [_result(SessionName="Qualifying", Time=None, Points=None,
                                GridPosition=None, Laps=None, Status=None,
                                ClassifiedPosition=None)])
    out = D.validate_session({"results": quali, "laps": None, "weather": None},
                             session_name="Qualifying")
    assert set(out) == {"results"}
    valid, invalid = out["results"]
    assert valid.count() == 1 and invalid.count() == 0
    assert D.validate_session({"results": None, "laps": None}) == {}


def test_track_status_labels_follow_data(spark):
    df = spark.createDataFrame([("4",), ("7",), ("1",)], "Status string")
    got = {r.Status: (r.message, r.enum_label) for r in D.label_track_status(df).collect()}
    assert got["4"] == ("SCDeployed", "DOUBLE_YELLOW")
    assert got["7"] == ("VSCEnding", "RED_FLAG")


def test_validation_is_one_projection(spark):
    df = spark.range(10).withColumn("x", F.col("id") - 5)
    plan = v.validate(df, [v.in_range("x", 0, None)])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan


def test_raise_on_invalid_in_plan(spark):
    ok = _df(spark, [_result()])
    assert v.raise_on_invalid(ok, D.RACE_RESULT_RULES).count() == 1
    bad = _df(spark, [_result(), _result(DriverNumber="ABC")])
    with pytest.raises(Exception, match="ABC"):
        v.raise_on_invalid(bad, D.RACE_RESULT_RULES).collect()


def test_rows_are_told_apart_without_messages(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "a"), (200, None), (5, None)], "x int, y string")
    rules = [v.in_range("x", 0, 100), v.required("y"), v.in_domain("y", ["b"])]
    valid, invalid = v.split_valid(rows, rules)
    for part in (valid, invalid):
        assert "concat" not in part.groupBy().count()._jdf.queryExecution().optimizedPlan().toString()
    checked = v.validate(rows, rules)
    assert [tuple(r) for r in valid.collect()] == [(1, "a")]
    assert {tuple(map(str, r)) for r in invalid.collect()} == {(str(r.x), str(r.y), str(r.errors)) for r in checked.collect() if r.errors}
    assert invalid.columns == ["x", "y", "errors"] and invalid.count() == 3
