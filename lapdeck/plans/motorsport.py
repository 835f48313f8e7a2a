"""End-to-end jobs over landed timing data (the reference's three entry
points, as Spark plans).

    catalog_job        manifest -> catalog -> validation -> Parquet + CSV
    race_results_job   catalog + results fan-in -> race results + checks
    lap_features_job   catalog + laps fan-in -> per-driver features + checks

Every job is one lazy plan per output; nothing loops over races or drivers
on the driver.  Inputs are read in the reference's layout
(``year/event/session/type.parquet``) with :func:`read_landed`, which gates every file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.functions.columns import duration_seconds
from lapdeck.operators import catalog as C
from lapdeck.operators import checks as K
from lapdeck.operators.results import (ResultsSpec, race_results, select_races,
                                       skipped_races)
from lapdeck.operators.sequences import SequenceSpec, dataset_statistics, sequence_features
from lapdeck.session import scratch_path
from lapdeck.sources.manifest import list_files
from lapdeck.sources.landed import landed_gate, read_landed, session_reasons
from lapdeck.sources.sinks import write_csv, write_parquet, write_sample

SESSION_KEYS = ["year", "event", "session"]


@dataclass
class JobOutput:
    data: DataFrame
    checks: DataFrame
    skips: DataFrame | None = None
    extra: dict | None = None


# ------------------------------------------------------------------- ingest
def ingest_plan(schedule: DataFrame, landed_files: DataFrame | None = None,
                events: list[str] | None = None, sessions: list[str] | None = None,
                enabled: list[str] | None = None, ledger: DataFrame | None = None,
                mode: str | None = None, year: int | None = None) -> DataFrame:
    """P2-P6 + P16: what to fetch.  One row per (event, session, data_type)
    still missing, after scope resolution, the enabled-session filter, the
    gap plan against the landed manifest and (optionally) the run ledger
    (``skip_existing`` / ``retry_failed``).  Fetching itself is a network
    client and not part of this engine; this is the dry-run plan."""
    from lapdeck.operators import planning as P
    plan = P.resolve_scope(schedule, events, sessions).withColumnRenamed("EventName", "event_name")
    plan = plan.filter(F.col("session").isNotNull() & (F.col("session") != ""))
    if enabled:
        plan = P.filter_enabled(plan, enabled)
    from lapdeck.functions.columns import event_key
    plan = plan.withColumn("event", event_key("event_name"))
    if year is not None:
        plan = plan.withColumn("year", F.lit(year))
    keys = ["year", "event", "session"] if year is not None else ["event", "session"]
    if ledger is not None and mode:
        plan = P.plan_remaining(plan, ledger, keys, mode)
    expected = P.expected_files(plan, [*keys, "event_name"])
    if landed_files is None:
        return expected
    landed = landed_files
    if year is not None and "year" not in landed.columns:
        landed = landed.withColumn("year", F.col("year_part").try_cast("int"))
    return P.gap_plan(expected, landed, keys)


# ------------------------------------------------------------------ catalog
def catalog_job(spark: SparkSession, root: str, as_of: str | None = None,
                out: str | None = None, first_year: int | None = 2020,
                last_year: int | None = None,
                glob: str = "*.parquet") -> JobOutput:
    """Build, validate and (optionally) store the catalog."""
    files = C.parse_manifest(list_files(spark, root, glob), root)
    session_info = read_landed(spark, root, "session_info")
    results = read_landed(spark, root, "results")
    # the catalog feeds every later job: written once as a table
    cat = stored(C.build_catalog(files, session_info, results, lo=first_year, hi=last_year))
    validated, verdict = C.validate_catalog(cat, as_of)
    if out:
        ordered = validated.orderBy(F.col("year").asc_nulls_last(),
                                    F.col("round").asc_nulls_last(), "session")
        write_parquet(ordered, f"{out}/race_catalog.parquet")
        write_csv(ordered, f"{out}/race_catalog.csv")
    return JobOutput(validated, verdict, extra={"issues": C.catalog_issues(cat)})


def build_statistics(catalog: DataFrame) -> DataFrame:
    """Totals, mean completeness (2 dp), practice sessions (counted
    case-insensitively), one row."""
    return catalog.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if("is_complete").alias("complete_sessions"),
        F.count_if(~F.col("is_complete")).alias("incomplete_sessions"),
        F.round(F.avg("completeness_score"), 2).alias("mean_completeness"),
        F.count_if(F.col("session") == "Race").alias("races"),
        F.count_if(F.lower("session").startswith("practice")).alias("practice_sessions"))


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """C14: one row per year and one for all (``is_total``, year NULL): entries, complete ones and their share in percent, races and
    complete races, qualifying sessions, first and last year, number of years, mean completeness.  One rollup."""
    race, complete = F.col("session") == "Race", F.coalesce("is_complete", F.lit(False))
    out = catalog.withColumn("__y", F.col("year")).rollup("year").agg(
        F.count("*").alias("entries"), F.count_if(complete).alias("complete"), F.count_if(~complete).alias("incomplete"),
        F.count_if(race).alias("races"), F.count_if(race & complete).alias("complete_races"), F.count_if(F.col("session") == "Qualifying").alias("qualifying"),
        F.min("__y").alias("first_year"), F.max("__y").alias("last_year"), F.count_distinct("__y").alias("years"),
        F.avg("completeness_score").alias("mean_score"), F.grouping("year").alias("__g"))
    share = F.col("complete") * 100.0 / F.col("entries")
    return out.select("year", (F.col("__g") == 1).alias("is_total"), "entries", "complete", "incomplete", share.alias("complete_pct"), "races", "complete_races",
                      "qualifying", "first_year", "last_year", "years", "mean_score").filter(F.col("entries") > 0)


def races_by_year(catalog: DataFrame) -> DataFrame:
    """Races per year."""
    return (catalog.filter(F.col("session") == "Race").groupBy("year")
            .agg(F.count(F.lit(1)).alias("races")))


# ------------------------------------------------------------------ results
def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: column pruning and
    statistics stay, and the files outlive any executor."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def results_output_checks(df: DataFrame, materialise: bool = True) -> DataFrame:
    """Rows per race in [15, 25], unique (race, driver), required columns,
    null shares of finish <= 0.30 and grid <= 0.05, positions in 1..25."""
    if materialise:
        df = stored(df)
    return K.run_checks(df, [
        K.rows_per_key("rows_per_race", "race_id", 15, 25),
        K.duplicates("duplicate_race_driver", ["race_id", "driver_id"]),
        K.required("required_columns", ["race_id", "driver_number", "finish_position",
                                        "grid_position", "points", "status"]),
        K.nulls("finish_position_nulls", "finish_position", 0.30),
        K.nulls("grid_position_nulls", "grid_position", 0.05),
        K.in_range("finish_position_range", "finish_position", 1, 25),
    ])


def _skips(spark: SparkSession, root: str, data_type: str, selected: DataFrame, produced: DataFrame,
           otherwise: str = "no rows") -> DataFrame:
    """The selected races without output and the gate's reason (``missing`` without an object)."""
    gate = landed_gate(spark, root, data_type)
    seen = gate.select(*SESSION_KEYS).distinct().withColumn("seen", F.lit(True))
    skipped = skipped_races(selected.select(*SESSION_KEYS, "race_id"), produced, ["race_id"], "")
    skipped = skipped.drop("reason").join(session_reasons(gate), SESSION_KEYS, "left").join(seen, SESSION_KEYS, "left")
    why = F.coalesce("reason", F.when(F.col("seen").isNull(), "missing").otherwise(otherwise))
    return skipped.select("race_id", why.alias("reason"))


def race_results_job(spark: SparkSession, root: str, catalog: DataFrame,
                     first_n: int | None = None, out: str | None = None) -> JobOutput:
    """R1-R13."""
    results = read_landed(spark, root, "results")
    cat = catalog.withColumn("race_date", F.col("session_date"))
    res = race_results(cat, results, ResultsSpec(), SESSION_KEYS, first_n)
    order = [F.col("race_date").asc_nulls_last(), F.col("finish_position").asc_nulls_last(), "driver_number"]
    res = stored(res).orderBy(*order)
    skips = _skips(spark, root, "results", select_races(catalog, first_n=first_n), res)
    if out:
        write_parquet(res, f"{out}/race_results.parquet")
        write_csv(res, f"{out}/race_results.csv")
    from lapdeck.operators.results import qualifying_warnings
    warnings = qualifying_warnings(res, "race_id", ("q1", "q2", "q3"), "q1")
    return JobOutput(res, results_output_checks(res, materialise=False), skips, extra={"warnings": warnings})


# --------------------------------------------------------------------- laps
LAP_SPEC = SequenceSpec(group=("race_id", "DriverNumber"), order=("LapNumber", "Time"))


def prepare_laps(laps: DataFrame) -> DataFrame:
    """L1 + P11: lap / sector times in seconds (durations, text or numbers)."""
    schema = {f.name: f.dataType for f in laps.schema.fields}
    cols = {}
    times = [duration_seconds(c, schema[c]) for c in ("LapTimeSeconds", "LapTime") if c in schema]
    if times:
        cols["LapTimeSeconds"] = F.coalesce(*times)
    for i in (1, 2, 3):
        src = f"Sector{i}Time"
        if src in schema:
            cols[f"Sector{i}Seconds"] = duration_seconds(src, schema[src])
    return laps.withColumns(cols) if cols else laps


def features_output_checks(df: DataFrame, materialise: bool = True) -> DataFrame:
    """Rows per race in [15, 25], unique (race, driver), required
    columns, mean lap in 60..180, null shares <= 0.10, groups with a valid
    share below 0.5 (reported as a range check on valid_lap_pct)."""
    if materialise:
        df = stored(df)
    return K.run_checks(df, [
        K.rows_per_key("rows_per_race", "race_id", 15, 25),
        K.duplicates("duplicate_race_driver", ["race_id", "driver_number"]),
        K.required("required_columns", ["race_id", "driver_number", "total_laps",
                                        "valid_laps", "avg_lap_time", "best_lap_time",
                                        "lap_time_std"]),
        K.in_range("avg_lap_time_range", "avg_lap_time", 60, 180),
        K.nulls("avg_lap_time_nulls", "avg_lap_time", 0.10),
        K.nulls("best_lap_time_nulls", "best_lap_time", 0.10),
        K.in_range("low_valid_share", "valid_lap_pct", 0.5, None),
    ])


def lap_features_job(spark: SparkSession, root: str, catalog: DataFrame,
                     first_n: int | None = None, out: str | None = None) -> JobOutput:
    """Laps of the selected complete races -> one row per driver."""
    races = (select_races(catalog, first_n=first_n)
             .select(*SESSION_KEYS, "race_id", "round",
                     "event_name", "circuit",
                     F.col("session_date").alias("race_date")))
    laps = read_landed(spark, root, "laps").join(
        races.select(*SESSION_KEYS, "race_id"), SESSION_KEYS, "inner")
    feats = sequence_features(prepare_laps(laps), LAP_SPEC)
    meta = races.select("race_id", "year", "round", "event_name", "circuit", "race_date")
    feats = (feats.join(meta, ["race_id"], "left")
             .withColumnRenamed("DriverNumber", "driver_number"))
    order = ["race_id", "year", "round", "event_name", "circuit", "race_date", "driver_number"]
    feats = feats.select(*order, *[c for c in feats.columns if c not in order])
    feats = stored(feats).orderBy(F.col("race_date").asc_nulls_last(), "driver_number")
    skips = _skips(spark, root, "laps", races, feats, "no valid laps")
    if out:
        write_parquet(feats, f"{out}/lap_features.parquet")
        write_csv(feats, f"{out}/lap_features.csv")
        write_sample(feats, f"{out}/lap_features_sample.csv", ["race_date", "driver_number"])
    return JobOutput(feats, features_output_checks(feats, materialise=False), skips,
                     extra={"statistics": dataset_statistics(feats)})


def report_tables(validated: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """The summary report's tables (no Markdown): overall counts, rows
    with warnings / errors, per (year, session) totals most frequent first,
    mean completeness per year, the first ``n`` incomplete and warned rows and
    how many did not fit."""
    order = [F.col("year").asc_nulls_last(), F.col("round").asc_nulls_last(), F.col("session")]
    flagged = validated.filter((F.col("validation_warnings") != "")
                               | (F.col("validation_errors") != ""))
    incomplete = validated.filter(~F.col("is_complete"))
    warned = validated.filter(F.col("validation_warnings") != "")
    return {
        "overall": build_statistics(validated),
        "flagged": flagged,
        "by_year_session": C.breakdown(validated, ["year", "session"], F.col("is_complete")),
        "mean_score_by_year": validated.groupBy("year").agg(
            F.round(F.avg("completeness_score"), 2).alias("mean_completeness")),
        "first_incomplete": C.first_n(incomplete, n, order),
        "first_warned": C.first_n(warned, n, order),
        "overflow": validated.sparkSession.range(1).select(
            C.overflow_count(incomplete, n).alias("incomplete_not_shown"),
            C.overflow_count(warned, n).alias("warned_not_shown")),
    }
