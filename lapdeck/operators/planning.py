"""Ingestion planning and enrichment.

The reference plans work with nested Python loops over events and sessions;
here each plan is a DataFrame: scope = unpivot / explode, gaps = anti-join,
precedence = min-rank aggregate + semi-join, ledger summaries = aggregates.
Small literal lists (session names, data types) enter plans through
``explode(array(...))`` -- a generator, not a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.operators.catalog import DATA_TYPES

SLOTS = ("Session1", "Session2", "Session3", "Session4", "Session5")
# Enabled-session groups.
PRACTICE = ("Practice 1", "Practice 2", "Practice 3")
QUALIFYING = ("Qualifying",)
SPRINT = ("Sprint", "Sprint Shootout", "Sprint Qualifying")


def _arr(values: Sequence) -> Column:
    return F.array(*[F.lit(x) for x in values])


# --------------------------------------------------------------------- P1
def season_tag(df: DataFrame, year: int | Column, name: str = "Season") -> DataFrame:
    return df.withColumn(name, year if isinstance(year, Column) else F.lit(year))


# --------------------------------------------------------------------- P2
def event_filter(df: DataFrame, name_col: str = "EventName",
                 include_testing: bool = False) -> DataFrame:
    """Drop NULL / empty names and, unless testing is on, names containing
    ``Test`` (case-sensitive)."""
    c = F.col(name_col)
    cond = c.isNotNull() & (c != "")
    if not include_testing:
        cond = cond & ~c.contains("Test")
    return df.filter(cond)


# --------------------------------------------------------------------- P3
def schedule_unpivot(df: DataFrame, ids: Sequence[str], slots: Sequence[str] = SLOTS,
                     slot_col: str = "slot", value_col: str = "session",
                     drop_empty: bool = True) -> DataFrame:
    """One row per (event, slot, session).  ``drop_empty`` removes NULL / empty
    slots (the partition-key variant); ``unpivot`` itself keeps them."""
    out = df.unpivot(list(ids), list(slots), slot_col, value_col)
    if drop_empty:
        out = out.filter(F.col(value_col).isNotNull() & (F.col(value_col) != ""))
    return out


# --------------------------------------------------------------------- P4
def resolve_scope(schedule: DataFrame, events: Sequence[str] | None = None,
                  sessions: Sequence[str] | None = None, event_col: str = "EventName",
                  slots: Sequence[str] = SLOTS, include_testing: bool = False,
                  keep_empty_slots: bool = True) -> DataFrame:
    """(event, session) pairs for the 9 combinations of optional event and
    session lists.  Listed events / sessions are not checked against the
    schedule (as in the reference); without a session list each event's
    slots are used, without an event list the filtered schedule is used."""
    spark = schedule.sparkSession
    if events:
        ev = spark.range(1).select(F.explode(_arr(list(events))).alias(event_col))
        if sessions:
            out = ev.withColumn("session", F.explode(_arr(list(sessions))))
        else:
            out = (schedule_unpivot(schedule.join(ev, [event_col], "left_semi"),
                                    [event_col], slots, drop_empty=not keep_empty_slots)
                   .select(event_col, "session"))
            # an event listed twice is planned twice, like the reference's loop
            out = ev.join(out, [event_col], "inner")
    else:
        ev = event_filter(schedule, event_col, include_testing)
        if sessions:
            out = ev.select(event_col).withColumn("session", F.explode(_arr(list(sessions))))
        else:
            out = (schedule_unpivot(ev, [event_col], slots, drop_empty=not keep_empty_slots)
                   .select(event_col, "session"))
    return out.select(event_col, "session")


def scope_mode(events: Sequence[str] | None, sessions: Sequence[str] | None) -> str:
    """Name of the scope mode (for the run ledger)."""
    e = "all_events" if not events else ("one_event" if len(events) == 1 else "multiple_events")
    s = "all_sessions" if not sessions else ("one_session" if len(sessions) == 1
                                            else "multiple_sessions")
    if e == "all_events" and s == "all_sessions":
        return "whole_season"
    return f"{e}_{s}"


# --------------------------------------------------------------------- P5
def enabled_sessions(include_practice: bool = False, include_qualifying: bool = False,
                     include_sprint: bool = False) -> list[str]:
    out = ["Race"]
    if include_practice:
        out += list(PRACTICE)
    if include_qualifying:
        out += list(QUALIFYING)
    if include_sprint:
        out += list(SPRINT)
    return out


def filter_enabled(df: DataFrame, enabled: Sequence[str], col: str = "session") -> DataFrame:
    return df.filter(F.col(col).isin(list(enabled)))


# ----------------------------------------------------------------- P6 P7
def expected_files(plan: DataFrame, keys: Sequence[str],
                   types: Sequence[str] = DATA_TYPES, type_col: str = "data_type") -> DataFrame:
    """Every planned session x every expected table (generator, not a join)."""
    return plan.select(*keys, F.explode(_arr(list(types))).alias(type_col))


def gap_plan(expected: DataFrame, landed: DataFrame, keys: Sequence[str],
             type_col: str = "data_type") -> DataFrame:
    """Expected (key, type) rows without a valid landed file."""
    return expected.join(landed.select(*keys, type_col).distinct(),
                         [*keys, type_col], "left_anti")


def session_state(expected: DataFrame, landed: DataFrame, keys: Sequence[str],
                  type_col: str = "data_type") -> DataFrame:
    """Per session -- cached and missing lists (in the expected
    order), counts, state none / partial / complete."""
    flagged = (expected
               .join(landed.select(*keys, type_col).distinct()
                     .withColumn("__landed", F.lit(True)), [*keys, type_col], "left")
               .withColumn("__landed", F.coalesce("__landed", F.lit(False))))
    agg = flagged.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("__landed"), F.col(type_col)))).alias("cached"),
        F.array_sort(F.collect_list(F.when(~F.col("__landed"), F.col(type_col)))).alias("missing"),
        F.count_if("__landed").alias("n_cached"),
        F.count(F.lit(1)).alias("n_expected"))
    state = (F.when(F.col("n_cached") == 0, F.lit("none"))
             .when(F.col("n_cached") == F.col("n_expected"), F.lit("complete"))
             .otherwise(F.lit("partial")))
    return agg.withColumns({"state": state,
                            "is_complete": F.col("n_cached") == F.col("n_expected"),
                            "is_partial": (F.col("n_cached") > 0)
                            & (F.col("n_cached") < F.col("n_expected"))})


def cache_sizes(landed: DataFrame, keys: Sequence[str], type_col: str = "data_type",
                size_col: str = "length") -> DataFrame:
    """Size (MB) per table as a map per session."""
    per = landed.groupBy(*keys, type_col).agg((F.sum(size_col) / 1048576.0).alias("mb"))
    return per.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(type_col, "mb"))))
        .alias("size_mb"))


# ----------------------------------------------------------------- P8 P9
def resolve_precedence(sources: Sequence[tuple[int, DataFrame]], keys: Sequence[str],
                       valid: Column | None = None, force_rank: int | None = None) -> DataFrame:
    """For each key take the rows of the best-ranked (lowest) source
    that has a valid row.  The winner per key is a ``min(rank)`` aggregate
    (map-side partial), then a semi-join keeps the winner's rows; no
    ``row_number`` window over a hot key.  ``force_rank`` keeps only that
    tier (force refresh = origin only)."""
    tagged = None
    for rank, df in sources:
        if force_rank is not None and rank != force_rank:
            continue
        t = df.withColumn("source_rank", F.lit(rank))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    if tagged is None:
        raise ValueError("no source left after force_rank")
    ok = tagged if valid is None else tagged.filter(valid)
    from lapdeck.functions.joins import join_back
    winners = ok.groupBy(*keys).agg(F.min("source_rank").alias("source_rank"))
    return join_back(ok, winners, [*keys, "source_rank"], "left_semi")


# -------------------------------------------------------------------- P10
def stamp_sessions(fact: DataFrame, session_info: DataFrame, keys: Sequence[str],
                   cols: dict[str, str] | None = None) -> DataFrame:
    """P10: attach EventName / SessionName / SessionDate from session info.
    Session info has one row per session; AQE broadcasts it when its
    measured size is small, otherwise the join stays a shuffle join."""
    cols = cols or {"event_name": "EventName", "session_name": "SessionName",
                    "session_date": "SessionDate"}
    si = session_info.select(*keys, *[F.col(s).alias(t) for s, t in cols.items()])
    return fact.drop(*[t for t in cols.values() if t in fact.columns]).join(si, list(keys), "left")


# -------------------------------------------------------------------- P12
def session_info_rows(schedule: DataFrame, plan: DataFrame, event_col: str = "EventName",
                      date_cols: Sequence[str] = ("Session1DateUtc", "Session2DateUtc",
                                                  "Session3DateUtc", "Session4DateUtc",
                                                  "Session5DateUtc"),
                      total_laps: DataFrame | None = None) -> DataFrame:
    """One metadata row per planned (event, session) from the schedule:
    location, country, date of that session's slot, format, round, official
    name and the five session names."""
    j = plan.join(schedule, [event_col], "inner")
    slot_date = F.coalesce(*[F.when(F.col(s) == F.col("session"), F.col(d))
                             for s, d in zip(SLOTS, date_cols)])
    out = j.select(
        F.col(event_col).alias("event_name"), F.col("Location").alias("location"),
        F.col("Country").alias("country"), F.col("session").alias("session_name"),
        slot_date.alias("session_date"), F.col("EventFormat").alias("event_format"),
        F.col("RoundNumber").alias("round_number"),
        F.col("OfficialEventName").alias("official_event_name"),
        *[F.col(s).alias(f"session_{i}") for i, s in enumerate(SLOTS, 1)])
    if total_laps is not None:
        out = out.join(total_laps, ["event_name", "session_name"], "left")
    else:
        out = out.withColumn("total_laps", F.lit(None).cast("int"))
    return out


# -------------------------------------------------------------------- P13
def session_overview(tables: dict[str, DataFrame], keys: Sequence[str],
                     driver_col: str = "DriverNumber") -> DataFrame:
    """has_laps / has_results / has_weather / has_messages, lap count and
    driver count per session, from one union + conditional aggregate."""
    parts = []
    for name, df in tables.items():
        drv = F.col(driver_col) if driver_col in df.columns and name == "laps" else F.lit(None)
        parts.append(df.select(*keys, F.lit(name).alias("__t"),
                               drv.cast("string").alias("__drv")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    t = F.col("__t")
    return u.groupBy(*keys).agg(
        F.coalesce(F.bool_or(t == "laps"), F.lit(False)).alias("has_laps"),
        F.coalesce(F.bool_or(t == "results"), F.lit(False)).alias("has_results"),
        F.coalesce(F.bool_or(t == "weather"), F.lit(False)).alias("has_weather"),
        F.coalesce(F.bool_or(t == "race_control_messages"), F.lit(False)).alias("has_messages"),
        F.count_if(t == "laps").alias("lap_count"),
        F.count_distinct(F.when(t == "laps", F.col("__drv"))).alias("driver_count"))


# ------------------------------------------------------------- P14 P16
LEDGER_SCHEMA = ("year int, event string, session string, attempt_ts timestamp, "
                 "success boolean, loaded_types array<string>, error string")


def ledger_summary(ledger: DataFrame, event_col: str = "event",
                   success_col: str = "success") -> DataFrame:
    """Attempts, successes, failures, success rate %, distinct successful
    events (one row)."""
    ok = F.coalesce(F.col(success_col), F.lit(False))
    s = ledger.agg(F.count(F.lit(1)).alias("attempts"),
                   F.count_if(ok).alias("successes"),
                   F.count_if(~ok).alias("failures"),
                   F.count_distinct(F.when(ok, F.col(event_col))).alias("successful_events"))
    return s.withColumn("success_rate", F.coalesce(
        F.try_divide(F.col("successes") * 100.0, F.col("attempts")), F.lit(0.0)))


def latest_status(ledger: DataFrame, keys: Sequence[str], ts_col: str = "attempt_ts",
                  success_col: str = "success") -> DataFrame:
    """Latest attempt per key (``max_by`` -- partial aggregate)."""
    return ledger.groupBy(*keys).agg(
        F.max_by(F.col(success_col), F.col(ts_col)).alias("latest_success"),
        F.max(ts_col).alias("latest_attempt"),
        F.count(F.lit(1)).alias("attempts"))


def plan_remaining(plan: DataFrame, ledger: DataFrame, keys: Sequence[str],
                   mode: str = "skip_existing", ts_col: str = "attempt_ts",
                   success_col: str = "success") -> DataFrame:
    """``skip_existing`` = plan minus keys with a success;
    ``retry_failed`` = keys whose latest attempt failed."""
    if mode == "skip_existing":
        done = ledger.filter(F.col(success_col)).select(*keys)
        return plan.join(done, list(keys), "left_anti")
    if mode == "retry_failed":
        failed = (latest_status(ledger, keys, ts_col, success_col)
                  .filter(~F.col("latest_success")).select(*keys))
        return plan.join(failed, list(keys), "left_semi")
    raise ValueError(mode)
