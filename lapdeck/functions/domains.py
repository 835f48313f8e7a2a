"""Domain tables (V16) and the rule sets of the nine landed tables.

Small fixed dimensions are DataFrames joined with ``broadcast`` -- their
size is fixed by this file, so broadcasting them is always safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.operators import validation as v

# Session codes and names.
SESSION_CODES = [("R", "Race"), ("Q", "Qualifying"), ("S", "Sprint"),
                 ("SS", "Sprint Shootout"), ("SQ", "Sprint Qualifying"),
                 ("FP1", "Practice 1"), ("FP2", "Practice 2"), ("FP3", "Practice 3")]
# Driver statuses.
DRIVER_STATUSES = ["Finished", "Retired", "DNF", "Disqualified", "Not Classified",
                   "DNS", "Lapped"]
# Tyre compounds.
COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"]
# Track status codes -- label as the timing data writes it, and
# the enum label of the reference's schema (they disagree on 4 and 7).
TRACK_STATUS = [("1", "AllClear", "GREEN"), ("2", "Yellow", "YELLOW"),
                ("4", "SCDeployed", "DOUBLE_YELLOW"), ("5", "Red", "SAFETY_CAR"),
                ("6", "VSCDeployed", "VIRTUAL_SAFETY_CAR"), ("7", "VSCEnding", "RED_FLAG")]
# Session names accepted per results kind (soft rule).
RACE_SESSIONS = ["Race", "Sprint"]
PRACTICE_SESSIONS = ["Practice 1", "Practice 2", "Practice 3"]
QUALI_SESSIONS = ["Qualifying", "Sprint Qualifying", "Sprint Shootout"]


def session_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SESSION_CODES, "code string, session_name string")


def track_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRACK_STATUS,
                                 "status string, message string, enum_label string")


def compounds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in COMPOUNDS], "compound string")


def label_session_codes(df: DataFrame, code_col: str = "code", out: str = "session_name") -> DataFrame:
    """V16 lookup: the session's name of a code, NULL for an unknown one."""
    dim = session_codes(df.sparkSession).select(F.col("code").alias(code_col), F.col("session_name").alias(out))
    return df.join(F.broadcast(dim), [code_col], "left")


def mark_known(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """For each column ``c``, ``c_known``: whether its value is in the fixed list (NULL is not)."""
    return df.withColumns({f"{c}_known": F.coalesce(F.col(c).isin(values), F.lit(False)) for c, values in columns.items()})


def label_track_status(df: DataFrame, status_col: str = "Status") -> DataFrame:
    """V16 lookup: attach the data's message and the enum label."""
    dim = track_status(df.sparkSession).withColumnRenamed("status", status_col)
    return df.join(F.broadcast(dim), [status_col], "left")


STAMP = ["EventName", "SessionName", "SessionDate"]


def _air_track(p: set[str]) -> Column:
    # soft: track temperature below air temperature - 5 (when air temp non-zero)
    if not {"AirTemp", "TrackTemp"} <= p:
        return F.lit(True)
    a, t = F.col("AirTemp"), F.col("TrackTemp")
    return ~((a.isNotNull() & (a != 0)) & (t < a - 5))


SESSION_INFO_RULES = [
    *v.required_all(["event_name", "location", "country", "session_name", "event_format",
                     "official_event_name", "session_date", "round_number"]),
    v.in_range("total_laps", 0, 100, optional=True),
]

_RESULT_STRINGS = ["DriverNumber", "BroadcastName", "Abbreviation", "TeamName", "TeamColor",
                   "FirstName", "LastName", "FullName", "CountryCode"]

RACE_RESULT_RULES = [
    *v.required_all(_RESULT_STRINGS + ["TeamId", "ClassifiedPosition", "Status"] + STAMP),
    v.length_eq("Abbreviation", 3),
    v.int_string_range("DriverNumber", 1, 99),
    v.in_range("Position", 1, 22),
    v.in_range("GridPosition", 0, 22),
    v.in_range("Points", 0, 26),
    v.in_range("Laps", 0, 100),
    v.in_domain("SessionName", RACE_SESSIONS),
]

PRACTICE_RESULT_RULES = [
    *v.required_all(_RESULT_STRINGS + STAMP),
    v.length_eq("Abbreviation", 3),
    v.int_string_range("DriverNumber", 1, 99),
    v.in_domain("SessionName", PRACTICE_SESSIONS),
]

QUALI_RESULT_RULES = [
    *v.required_all(_RESULT_STRINGS + ["TeamId"] + STAMP),
    v.length_eq("Abbreviation", 3),
    v.int_string_range("DriverNumber", 1, 99),
    v.in_range("Position", 1, 22),
    v.in_domain("SessionName", QUALI_SESSIONS),
]

LAP_RULES = [
    *v.required_all(["Time", "LapTime", "LapStartTime", "Stint", "IsPersonalBest",
                     "Deleted", "FastF1Generated", "IsAccurate", "Team", "TrackStatus",
                     "DriverNumber"] + STAMP),
    v.length_eq("Driver", 3),
    v.in_range("LapNumber", 1, None),
    v.in_range("TyreLife", 0, 60, optional=True, integral=True),
    # compound is checked after upper-casing (the reference normalises first)
    v.custom("Compound unknown",
             lambda p: (F.col("Compound").isNull() | F.upper("Compound").isin(COMPOUNDS))
             if "Compound" in p else F.lit(True), "warning", "Compound"),
    v.custom("LapTime unusual (<60 s or >300 s)",
             lambda p: (F.col("LapTimeSeconds").between(60, 300) | F.col("LapTimeSeconds").isNull())
             if "LapTimeSeconds" in p else F.lit(True), "warning", "LapTimeSeconds"),
]

WEATHER_RULES = [
    *v.required_all(["Time", "Rainfall"] + STAMP),
    v.in_range("AirTemp", -10, 60),
    v.in_range("Humidity", 0, 100),
    v.in_range("Pressure", 900, 1100),
    v.in_range("TrackTemp", -10, 80),
    v.in_range("WindDirection", 0, 360, optional=True),
    v.custom("AirTemp unusual (<0 or >50)",
             lambda p: F.col("AirTemp").between(0, 50) if "AirTemp" in p else F.lit(True),
             "warning", "AirTemp"),
    v.custom("Humidity above 100",
             lambda p: (F.col("Humidity") <= 100) if "Humidity" in p else F.lit(True),
             "warning", "Humidity"),
    v.custom("TrackTemp below AirTemp - 5", _air_track, "warning", "TrackTemp"),
]

# optional: the wind speed range the reference declares but never enforces
WIND_SPEED_RULE = v.in_range("WindSpeed", 0, 50, optional=True)

RACE_CONTROL_RULES = [*v.required_all(["Time", "Category", "Message", "Lap"] + STAMP)]
SESSION_STATUS_RULES = [*v.required_all(["Time", "Status"] + STAMP)]
TRACK_STATUS_RULES = [*v.required_all(["Time", "Status", "Message"] + STAMP)]

RULES_BY_TABLE = {
    "session_info": SESSION_INFO_RULES,
    "laps": LAP_RULES,
    "weather": WEATHER_RULES,
    "race_control_messages": RACE_CONTROL_RULES,
    "session_status": SESSION_STATUS_RULES,
    "track_status": TRACK_STATUS_RULES,
}


def results_rules(session_name: str) -> list[v.Rule]:
    """Pick the results rule set by session name (race / qualifying /
    practice)."""
    if session_name in QUALI_SESSIONS:
        return QUALI_RESULT_RULES
    if session_name in PRACTICE_SESSIONS:
        return PRACTICE_RESULT_RULES
    return RACE_RESULT_RULES


def validate_session(tables: dict[str, DataFrame | None], session_name: str = "Race"
                     ) -> dict[str, tuple[DataFrame, DataFrame]]:
    """V4: run the matching rule set on each table present; absent tables give
    no entry.  Returns {table: (valid rows, invalid rows with errors)}."""
    out = {}
    for name, df in tables.items():
        if df is None:
            continue
        rules = results_rules(session_name) if name == "results" else RULES_BY_TABLE.get(name)
        if rules is None:
            continue
        out[name] = v.split_valid(df, rules)
    return out
