"""Race results joined with qualifying, plus outcome features.

Skew notes: "first match" selections are ``row_number() = 1`` filters, which
Spark plans with a map-side WindowGroupLimit (at most one row per key and
task crosses the shuffle); the race/qualifying join is an equi-join on
(race keys, driver) that AQE's skew-join handling can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.functions.columns import duration_seconds

# Statuses that count as a finished race.
FINISHED_STATUSES = ("Finished", "Lapped", "+1 Lap", "+2 Laps")

# Reference column names -> output names.
RENAMES = {
    "DriverNumber": "driver_number", "DriverId": "driver_id",
    "Abbreviation": "driver_abbreviation", "FullName": "full_name",
    "TeamName": "team_name", "TeamId": "team_id", "TeamColor": "team_color",
    "GridPosition": "grid_position", "Position": "finish_position",
    "ClassifiedPosition": "classified_position", "Points": "points",
    "Laps": "laps_completed", "Status": "status", "Q1": "q1", "Q2": "q2",
    "Q3": "q3", "Time": "race_time", "Q1_seconds": "q1_seconds",
    "Q2_seconds": "q2_seconds", "Q3_seconds": "q3_seconds",
    "Time_seconds": "race_time_seconds",
}

# Output column order (extras follow).
OUTPUT_ORDER = (
    "race_id", "year", "round", "event_name", "circuit", "race_date",
    "driver_number", "driver_id", "driver_abbreviation", "full_name",
    "team_id", "team_name", "team_color",
    "q1", "q2", "q3", "q1_seconds", "q2_seconds", "q3_seconds",
    "grid_position", "finish_position", "classified_position", "position_gain",
    "points", "laps_completed", "status", "race_time", "race_time_seconds",
    "finished_race", "dnf", "finished_top10",
)


@dataclass(frozen=True)
class ResultsSpec:
    race_keys: tuple[str, ...] = ("year", "round")
    driver: str = "DriverNumber"
    finish: str = "Position"
    grid: str = "GridPosition"
    status: str = "Status"
    finished_statuses: tuple[str, ...] = FINISHED_STATUSES
    top_n: int = 10
    quali_cols: tuple[str, ...] = ("Q1", "Q2", "Q3")
    duration_cols: tuple[str, ...] = ("Q1", "Q2", "Q3", "Time")
    extra: tuple[str, ...] = field(default_factory=tuple)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  cols: Sequence[str] | None = None) -> DataFrame:
    """First row per key by ``order``.

    ``row_number() = 1`` is planned with a map-side ``WindowGroupLimit``:
    every task sorts its own rows and forwards at most one row per key before
    the shuffle, so a key holding a third of all rows costs one row per task
    in the exchange (same bound as a partial aggregate, and faster than
    ``min_by`` over structs, which needs sort-based aggregation).
    ``order`` should be a total order; on ties the row is any of the tied ones.
    """
    from pyspark.sql import Window
    cols = [c for c in (cols or df.columns) if c not in keys]
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*ords)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).select(*keys, *cols))


def select_races(catalog: DataFrame, session_col: str = "session",
                 session: str = "Race", complete_col: str = "is_complete",
                 order: Sequence[str] = ("year", "round", "session"),
                 first_n: int | None = None) -> DataFrame:
    """Complete sessions of one kind, optionally the first N in catalog
    order (0/None = all)."""
    sel = catalog.filter((F.col(session_col) == session) & F.col(complete_col))
    if first_n:
        sel = sel.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(first_n)
    return sel


def qualifying_for_races(catalog: DataFrame, keys: Sequence[str] = ("year", "round"),
                         session_col: str = "session", session: str = "Qualifying",
                         complete_col: str = "is_complete",
                         order: Sequence[str] = ("event", "session")) -> DataFrame:
    """The first complete qualifying session of each (year, round)."""
    q = catalog.filter((F.col(session_col) == session) & F.col(complete_col))
    return first_per_key(q, list(keys), list(order))


def attach_qualifying(race: DataFrame, quali: DataFrame, spec: ResultsSpec = ResultsSpec(),
                      keys: Sequence[str] | None = None) -> DataFrame:
    """Left join qualifying columns on (race keys, driver).  A race
    without qualifying gets NULLs; duplicate right keys multiply rows exactly
    like an SQL join."""
    keys = list(keys if keys is not None else (*spec.race_keys, spec.driver))
    qcols = [c for c in quali.columns if c not in keys]
    r = race.drop(*[c for c in qcols if c in race.columns])
    return r.join(quali.select(*keys, *qcols), keys, "left")


def qualifying_warnings(joined: DataFrame, race_col: str = "race_id",
                        q_cols: Sequence[str] = ("Q1", "Q2", "Q3"), q1: str = "Q1") -> DataFrame:
    """R4 warnings per race: no qualifying at all (every Q column NULL for
    every driver) and the number of drivers without a Q1 time."""
    present = [c for c in q_cols if c in joined.columns]
    any_q = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in present]) \
        if present else F.lit(False)
    no_q1 = F.col(q1).isNull() if q1 in joined.columns else F.lit(True)
    return joined.groupBy(race_col).agg(
        (~F.coalesce(F.bool_or(any_q), F.lit(False))).alias("missing_qualifying"),
        F.count_if(no_q1).alias("drivers_without_q1"))


def outcome_features(df: DataFrame, spec: ResultsSpec = ResultsSpec()) -> DataFrame:
    """Position gain, top-N, finished / dnf, durations in seconds."""
    fin, grid = F.col(spec.finish), F.col(spec.grid)
    finished = F.coalesce(F.col(spec.status).isin(list(spec.finished_statuses)), F.lit(False))
    new: dict[str, Column] = {
        "position_gain": grid - fin,
        "finished_top10": F.coalesce(fin <= spec.top_n, F.lit(False)),
        "finished_race": finished,
        "dnf": ~finished,
    }
    types = dict(df.dtypes)
    schema = {f.name: f.dataType for f in df.schema.fields}
    for c in spec.duration_cols:
        if c in types:
            new[f"{c}_seconds"] = duration_seconds(c, schema[c])
    return df.withColumns(new)


def standardize(df: DataFrame, renames: dict[str, str] | None = None,
                order: Sequence[str] = OUTPUT_ORDER) -> DataFrame:
    """Rename to snake_case, fixed order, extras last."""
    renames = {k: v for k, v in (renames or RENAMES).items() if k in df.columns}
    df = df.withColumnsRenamed(renames)
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def race_results(catalog: DataFrame, results: DataFrame,
                 spec: ResultsSpec = ResultsSpec(),
                 session_keys: Sequence[str] = ("year", "event", "session"),
                 first_n: int | None = None) -> DataFrame:
    """R1-R11 end to end over a catalog and the fan-in results table.

    ``results`` carries the session keys as columns (partition columns of
    the landed dataset).  Qualifying rows are selected by a semi-join with
    the chosen qualifying sessions, never by a per-race loop.
    """
    sk = list(session_keys)
    extra_keys = [k for k in spec.race_keys if k not in sk]
    meta_cols = [c for c in ("race_id", "event_name", "circuit", "race_date")
                 if c in catalog.columns]
    races = (select_races(catalog, first_n=first_n)
             .select(*sk, *extra_keys, *meta_cols).dropDuplicates(sk))
    quals = qualifying_for_races(catalog).select(*sk, *extra_keys)
    qcols = [c for c in spec.quali_cols if c in results.columns]
    race_rows = results.drop(*qcols).join(races, sk, "inner")
    qual_rows = (results.join(quals, sk, "inner")
                 .select(*spec.race_keys, spec.driver, *qcols))
    joined = attach_qualifying(race_rows, qual_rows, spec)
    feats = outcome_features(joined, spec)
    if "race_date" in feats.columns:
        ordered = feats.orderBy(F.col("race_date").asc_nulls_last(),
                                F.col(spec.finish).asc_nulls_last(), spec.driver)
    else:
        ordered = feats
    return standardize(ordered.drop("session", "event") if "event_name" in meta_cols
                       else ordered)


def skipped_races(selected: DataFrame, produced: DataFrame, keys: Sequence[str],
                  reason: Column | str = "results missing") -> DataFrame:
    """Selected races that produced no rows, with a reason
    (anti-join; no per-item exception handling)."""
    r = F.lit(reason) if isinstance(reason, str) else reason
    return (selected.join(produced.select(*keys).distinct(), list(keys), "left_anti")
            .withColumn("reason", r))


def accounting(selected: DataFrame, skipped: DataFrame) -> DataFrame:
    """Processed / skipped counts and rates, one row."""
    n_sel = selected.agg(F.count(F.lit(1)).alias("selected"))
    n_skip = skipped.agg(F.count(F.lit(1)).alias("skipped"))
    both = _one_row_merge(n_sel, n_skip)
    return both.select(
        "selected", "skipped",
        (F.col("selected") - F.col("skipped")).alias("processed"),
        F.coalesce(F.try_divide((F.col("selected") - F.col("skipped")) * 100.0,
                                F.col("selected")), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.try_divide(F.col("skipped") * 100.0, F.col("selected")),
                   F.lit(0.0)).alias("failure_rate"),
    )


def _one_row_merge(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side without a join: each becomes a
    scalar subquery."""
    first, rest = frames[0], frames[1:]
    cols = [F.col(c) for c in first.columns]
    for fr in rest:
        for c in fr.columns:
            cols.append(fr.select(c).scalar().alias(c))
    return first.select(*cols)
