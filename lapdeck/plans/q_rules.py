"""The rule sets of the landed tables (V4-V13), fail-fast (V2) and the track-status lookup (V16) on ``lineitem``.

Each line is cast into the columns of one landed table by expressions of its key, with planted faults:
nulls, values out of range, wrong lengths, unknown names.  The expressions are plain SQL that Spark
and DuckDB read alike; the oracle writes every rule out again and counts the broken ones row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.functions import domains as D
from lapdeck.operators import validation as v
from lapdeck.plans.registry import register, table

KEY = "l_orderkey * 10 + l_linenumber"
_PRIMES = (53, 59, 61, 67, 71, 73, 79, 83, 89, 97, 101, 103, 107, 109, 113, 127, 131, 137, 139)


def _text(value: str = "'v'") -> str:
    return f"CASE WHEN k % {{p}} = 0 THEN NULL ELSE {value} END"


def _number(modulus: int, low: int) -> str:
    return f"CASE WHEN k % {{p}} = 0 THEN NULL ELSE CAST(k % {modulus} AS DOUBLE) + {low} END"


_STAMP = {"EventName": _text(), "SessionName": _text("CASE k % 4 WHEN 0 THEN 'Race' WHEN 1 THEN 'Qualifying' WHEN 2 THEN 'Practice 2' ELSE 'Other' END"),
          "SessionDate": _text("TIMESTAMP '2024-03-01 15:00:00'")}
_PERSON = {c: _text() for c in ("BroadcastName", "TeamName", "TeamColor", "FirstName", "LastName", "FullName", "CountryCode")} | {
    "DriverNumber": _text("CASE WHEN k % 17 = 0 THEN 'x1' ELSE CAST(k % 120 AS STRING) END"),
    "Abbreviation": _text("CASE WHEN k % 19 = 0 THEN 'AB' ELSE 'ABC' END")}

COLUMNS: dict[str, dict[str, str]] = {
    "session_info": {c: _text() for c in ("event_name", "location", "country", "session_name", "event_format", "official_event_name")} | {
        "session_date": _text("TIMESTAMP '2024-03-01 15:00:00'"), "round_number": _number(24, 1), "total_laps": _number(130, -10)},
    "race": _PERSON | {"TeamId": _text(), "ClassifiedPosition": _text(), "Status": _text(), "Position": _number(26, 0), "GridPosition": _number(26, -1),
                       "Points": _number(30, -1), "Laps": _number(110, -3)} | _STAMP,
    "practice": _PERSON | _STAMP,
    "qualifying": _PERSON | {"TeamId": _text(), "Position": _number(26, 0)} | _STAMP,
    "laps": {c: _text("1.5") for c in ("Time", "LapTime", "LapStartTime", "Stint")} | {c: _text("TRUE") for c in ("IsPersonalBest", "Deleted", "FastF1Generated", "IsAccurate")} | {
        "Team": _text(), "TrackStatus": _text("'1'"), "DriverNumber": _text("'1'"), "Driver": _text("CASE WHEN k % 19 = 0 THEN 'AB' ELSE 'ABC' END"),
        "LapNumber": _number(60, 0), "TyreLife": "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 140 AS DOUBLE) / 2 - 2 END",
        "Compound": _text("CASE k % 5 WHEN 0 THEN 'soft' WHEN 1 THEN 'HYPER' ELSE 'MEDIUM' END"), "LapTimeSeconds": _number(320, 20)} | _STAMP,
    "weather": {"Time": _text("1.5"), "Rainfall": _text("FALSE"), "AirTemp": _number(90, -20), "Humidity": _number(130, -10), "Pressure": _number(300, 850),
                "TrackTemp": _number(110, -20), "WindDirection": _number(400, -20)} | _STAMP,
    "race_control": {"Time": _text("1.5"), "Category": _text(), "Message": _text(), "Lap": _number(60, 0)} | _STAMP,
    "session_status": {"Time": _text("1.5"), "Status": _text()} | _STAMP,
    "track_status": {"Time": _text("1.5"), "Status": _text("CAST(k % 9 AS STRING)"), "Message": _text()} | _STAMP,
}

_STAMPS = ["EventName IS NULL", "SessionName IS NULL", "SessionDate IS NULL"]
_PERSONS = [f"{c} IS NULL" for c in ("DriverNumber", "BroadcastName", "Abbreviation", "TeamName", "TeamColor", "FirstName", "LastName", "FullName", "CountryCode")] + [
    "Abbreviation IS NULL OR length(Abbreviation) <> 3", "try_cast(DriverNumber AS INT) IS NULL OR try_cast(DriverNumber AS INT) NOT BETWEEN 1 AND 99"]


def _out(c: str, lo: int, hi: int) -> str:
    return f"{c} IS NULL OR {c} NOT BETWEEN {lo} AND {hi}"


#: What breaks a row, in SQL: errors and warnings by rule set.
BROKEN: dict[str, tuple[list[str], list[str]]] = {
    "session_info": ([f"{c} IS NULL" for c in ("event_name", "location", "country", "session_name", "event_format", "official_event_name", "session_date",
                                               "round_number")] + ["total_laps NOT BETWEEN 0 AND 100"], []),
    "race": (_PERSONS + ["TeamId IS NULL", "ClassifiedPosition IS NULL", "Status IS NULL", *_STAMPS, _out("Position", 1, 22), _out("GridPosition", 0, 22),
                         _out("Points", 0, 26), _out("Laps", 0, 100)], ["SessionName NOT IN ('Race', 'Sprint')"]),
    "practice": (_PERSONS + _STAMPS, ["SessionName NOT IN ('Practice 1', 'Practice 2', 'Practice 3')"]),
    "qualifying": (_PERSONS + ["TeamId IS NULL", *_STAMPS, _out("Position", 1, 22)], ["SessionName NOT IN ('Qualifying', 'Sprint Qualifying', 'Sprint Shootout')"]),
    "laps": ([f"{c} IS NULL" for c in ("Time", "LapTime", "LapStartTime", "Stint", "IsPersonalBest", "Deleted", "FastF1Generated", "IsAccurate", "Team",
                                       "TrackStatus", "DriverNumber")] + _STAMPS + ["Driver IS NULL OR length(Driver) <> 3", "LapNumber IS NULL OR LapNumber < 1",
                                                                                    "TyreLife NOT BETWEEN 0 AND 60 OR TyreLife <> floor(TyreLife)"],
             ["upper(Compound) NOT IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET')", "LapTimeSeconds NOT BETWEEN 60 AND 300"]),
    "weather": (["Time IS NULL", "Rainfall IS NULL", *_STAMPS, _out("AirTemp", -10, 60), _out("Humidity", 0, 100), _out("Pressure", 900, 1100),
                 _out("TrackTemp", -10, 80), "WindDirection NOT BETWEEN 0 AND 360"],
                ["AirTemp NOT BETWEEN 0 AND 50", "Humidity > 100", "AirTemp <> 0 AND TrackTemp < AirTemp - 5"]),
    "race_control": ([f"{c} IS NULL" for c in ("Time", "Category", "Message", "Lap")] + _STAMPS, []),
    "session_status": (["Time IS NULL", "Status IS NULL", *_STAMPS], []),
    "track_status": (["Time IS NULL", "Status IS NULL", "Message IS NULL", *_STAMPS], []),
}

RULES = {"session_info": D.SESSION_INFO_RULES, "race": D.results_rules("Race"), "practice": D.results_rules("Practice 2"),
         "qualifying": D.results_rules("Qualifying"), "laps": D.LAP_RULES, "weather": D.WEATHER_RULES, "race_control": D.RACE_CONTROL_RULES,
         "session_status": D.SESSION_STATUS_RULES, "track_status": D.TRACK_STATUS_RULES}
IDS = {"session_info": "V5", "race": "V6", "practice": "V7", "qualifying": "V8", "laps": "V9", "weather": "V10 V14", "race_control": "V11",
       "session_status": "V12", "track_status": "V13"}


def _expressions(name: str) -> list[str]:
    return [f"{e.format(p=p)} AS {c}" for (c, e), p in zip(COLUMNS[name].items(), _PRIMES, strict=False)]


def _as_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    keyed = table(spark, sf_dir, "lineitem").selectExpr(f"{KEY} AS k")
    return keyed.selectExpr("k", *_expressions(name))


def _oracle(name: str) -> str:
    errors, warnings = (" + ".join(f"COALESCE(({b}), FALSE)::INT" for b in part) or "0" for part in BROKEN[name])
    return (f"WITH t AS (SELECT {KEY} AS k FROM lineitem), x AS (SELECT k, {', '.join(_expressions(name))} FROM t) "
            f"SELECT k, ({errors})::INT AS errors, ({warnings})::INT AS warnings FROM x")


def _register(name: str) -> None:
    @register(f"rules_{name}", _oracle(name), IDS[name])
    def build(spark, sf_dir):
        checked = v.validate(_as_table(spark, sf_dir, name), RULES[name])
        return checked.select("k", F.size("errors").alias("errors"), F.size("warnings").alias("warnings"))


for _name in COLUMNS:
    _register(_name)


def _rejected(name: str) -> str:
    errors = " OR ".join(f"COALESCE(({b}), FALSE)" for b in BROKEN[name][0])
    return (f"SELECT '{name}' AS name, count(*) FILTER (WHERE NOT ({errors}))::BIGINT AS valid, count(*) FILTER (WHERE {errors})::BIGINT AS invalid "
            f"FROM (SELECT {', '.join(_expressions(name))} FROM (SELECT {KEY} AS k FROM lineitem))")


@register("validate_session", " UNION ALL ".join(_rejected(n) for n in ("qualifying", "laps", "weather")).replace("'qualifying' AS", "'results' AS"), "V4 (session dispatch)")
def q_validate_session(spark, sf_dir):
    tables = {"results": _as_table(spark, sf_dir, "qualifying"), "laps": _as_table(spark, sf_dir, "laps"), "weather": _as_table(spark, sf_dir, "weather"),
              "session_info": None}
    parts = [valid.agg(F.lit(name).alias("name"), F.count("*").alias("valid")).join(bad.agg(F.lit(name).alias("name"), F.count("*").alias("invalid")), "name")
             for name, (valid, bad) in D.validate_session(tables, "Qualifying").items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("validate_fail_fast", f"SELECT {KEY} AS k FROM lineitem WHERE l_quantity BETWEEN 1 AND 50", "V2 (in-plan fail fast)")
def q_fail_fast(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(f"{KEY} AS k", "l_quantity").filter("l_quantity between 1 and 50")
    return v.raise_on_invalid(rows, [v.in_range("l_quantity", 1, 50)]).select("k")


@register("track_status_label", f"""
WITH t AS (SELECT {KEY} AS k FROM lineitem), x AS (SELECT k, {COLUMNS['track_status']['Status'].format(p=59)} AS Status FROM t)
SELECT k, Status, CASE Status WHEN '1' THEN 'AllClear' WHEN '2' THEN 'Yellow' WHEN '4' THEN 'SCDeployed' WHEN '5' THEN 'Red' WHEN '6' THEN 'VSCDeployed'
  WHEN '7' THEN 'VSCEnding' END AS message, CASE Status WHEN '1' THEN 'GREEN' WHEN '2' THEN 'YELLOW' WHEN '4' THEN 'DOUBLE_YELLOW' WHEN '5' THEN 'SAFETY_CAR'
  WHEN '6' THEN 'VIRTUAL_SAFETY_CAR' WHEN '7' THEN 'RED_FLAG' END AS enum_label FROM x""", "V16 (lookup)")
def q_track_status(spark, sf_dir):
    return D.label_track_status(_as_table(spark, sf_dir, "track_status").select("k", "Status")).select("k", "Status", "message", "enum_label")
