"""Catalog of landed sessions with completeness and quality flags.

The catalog is an aggregate over a *file manifest* (one row per landed file:
year, event, session, data_type, size, mtime) plus two left joins (session
metadata, result quality).  Per-key flags use aggregate + join instead of
whole-partition windows: a key holding a third of all rows is then
pre-aggregated map-side, and the join back salts it over many tasks
(:func:`lapdeck.functions.joins.join_back`).  Global values
(earliest date) are scalar subqueries, not unpartitioned windows or cross
joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.functions.columns import race_id as race_id_col
from lapdeck.functions.columns import struct_order

# The seven per-session data types and the session names the
# catalog keeps.
DATA_TYPES = ("results", "laps", "weather", "session_info", "track_status",
              "session_status", "race_control_messages")
CRITICAL_TYPES = ("results", "laps", "session_info")
SESSION_TYPES = ("Practice 1", "Practice 2", "Practice 3", "Qualifying", "Sprint",
                 "Sprint Qualifying", "Sprint Shootout", "Race")

# Messages appended to validation columns.
MSG_MISSING_QUALI = "Missing qualifying session; "
MSG_MISSING_FILES = "Missing files: {}; "
MSG_NULL_POSITIONS = "Contains null positions (may be DNFs); "
MSG_DUPLICATE = "Duplicate entry; "
# Fixed value: days after which the latest race counts as stale.
MAX_AGE_DAYS = 21

# The catalog's columns in order.
CATALOG_COLUMNS = (
    "year", "round", "event_name", "circuit", "session", "session_date", "session_path",
    "has_results", "has_laps", "has_weather", "has_session_info", "has_track_status", "has_session_status", "has_race_control",
    "total_drivers", "total_laps", "event_format", "has_qualifying_data",
    "has_null_positions", "has_null_grid", "is_complete", "completeness_score",
)


# ------------------------------------------------------------------ C1 C2
def parse_manifest(manifest: DataFrame, root: str = "", path_col: str = "path",
                   layout: str = "nested") -> DataFrame:
    """Key columns from object paths.

    ``nested`` layout: ``year/event/session/type.parquet`` (season-level
    ``year/x.parquet`` files get NULL event / session; a ``type.parquet``
    folder of part files counts as one object per part).  ``hive`` layout:
    ``data_type=t/year=y/event=e/session=s/part-*.parquet`` as written by
    :func:`lapdeck.sources.sinks.write_sessions`."""
    if root:
        rel = F.regexp_replace(F.col(path_col), "^([a-z0-9]+:(//[^/]*)?)?" + _re_escape(_path_part(root)) + "/?", "")
    else:
        rel = F.regexp_replace(F.col(path_col), "^[a-z0-9]+:/*[^/]*/", "")
    if layout == "hive":
        def kv(k: str):
            v = F.regexp_extract(rel, f"(^|/){k}=([^/]+)", 2)
            return F.when(v != "", F.url_decode(v))
        return manifest.withColumns({"rel_path": rel, "year_part": kv("year"),
                                     "event": kv("event"), "session": kv("session"),
                                     "data_type": kv("data_type")})
    rx = r"^([^/]+)/([^/]+)/([^/]+)/([^/]+)\.parquet(/|$)"
    season = r"^([^/]+)/([^/]+)\.parquet(/|$)"
    is_session = F.regexp_like(rel, F.lit(rx))
    return manifest.withColumns({
        "rel_path": rel,
        "year_part": F.split(rel, "/").getItem(0),
        "event": F.when(is_session, F.regexp_extract(rel, rx, 2)),
        "session": F.when(is_session, F.regexp_extract(rel, rx, 3)),
        "data_type": F.when(is_session, F.regexp_extract(rel, rx, 4))
                      .otherwise(F.regexp_extract(rel, season, 2)),
    })


def _path_part(root: str) -> str:
    """The root without scheme and authority: listings name them whether or not the root did."""
    import re
    return re.sub(r"^[A-Za-z0-9]+:(//[^/]*)?", "", root).rstrip("/")


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def _within(year: Column, lo: int | None, hi: int | None) -> Column:
    return year.isNotNull() & (F.lit(True) if lo is None else year >= lo) & (F.lit(True) if hi is None else year <= hi)


def discover_years(files: DataFrame, lo: int | None = 2020, hi: int | None = None) -> DataFrame:
    """First path part numeric and not outside ``lo`` and ``hi`` (None: open)."""
    y = F.col("year_part").try_cast("int")
    return files.select(y.alias("year")).filter(_within(F.col("year"), lo, hi)).distinct()


def session_files(files: DataFrame, lo: int | None = 2020, hi: int | None = None,
                  sessions: Sequence[str] = SESSION_TYPES) -> DataFrame:
    """C1+C2: per-session files of valid years and known session names."""
    y = F.col("year_part").try_cast("int")
    return (files.withColumn("year", y)
            .filter(_within(F.col("year"), lo, hi) & F.col("session").isin(list(sessions))))


# ------------------------------------------------------------------ C3-C5
def presence_flags(df: DataFrame, keys: Sequence[str], type_col: str,
                   expected: Sequence[str], prefix: str = "has_",
                   extra: Sequence[Column] = ()) -> DataFrame:
    """One boolean per expected type (``bool_or``) plus ``n_present``;
    ``extra`` aggregates ride along in the same pass."""
    flags = [F.coalesce(F.bool_or(F.col(type_col) == t), F.lit(False)).alias(f"{prefix}{t}")
             for t in expected]
    out = df.groupBy(*keys).agg(*flags, *extra)
    n = reduce(lambda a, b: a + b, [F.col(f"{prefix}{t}").cast("int") for t in expected])
    return out.withColumn("n_present", n)


def completeness(df: DataFrame, expected: Sequence[str], critical: Sequence[str],
                 prefix: str = "has_") -> DataFrame:
    """C4 ``is_complete`` (all critical present) and C5 ``completeness_score``
    (present / expected x 100)."""
    crit = reduce(lambda a, b: a & b, [F.col(f"{prefix}{t}") for t in critical])
    n = reduce(lambda a, b: a + b, [F.col(f"{prefix}{t}").cast("int") for t in expected])
    return df.withColumns({"is_complete": crit,
                           "completeness_score": n / F.lit(len(expected)) * 100.0})


# ------------------------------------------------------------------ C6 C7
def attach_first(df: DataFrame, other: DataFrame, keys: Sequence[str],
                 order: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Left-join selected columns of the first ``other`` row per key
    (``cols`` maps source name -> output name)."""
    from lapdeck.operators.results import first_per_key
    first = first_per_key(other, list(keys), list(order), cols=list(cols))
    first = first.select(*keys, *[F.col(s).alias(t) for s, t in cols.items()])
    return df.join(first, list(keys), "left")


def quality_metrics(df: DataFrame, results: DataFrame, keys: Sequence[str],
                    null_cols: dict[str, str], count_name: str = "total_drivers") -> DataFrame:
    """Per key row count and "any NULL in column" flags, left-joined;
    absent keys get NULL count and False flags; an absent column gives False."""
    present = set(results.columns)
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for src, name in null_cols.items():
        aggs.append((F.bool_or(F.col(src).isNull()) if src in present else F.lit(False))
                    .alias(name))
    m = results.groupBy(*keys).agg(*aggs)
    out = df.join(m, list(keys), "left")
    return out.withColumns({name: F.coalesce(F.col(name), F.lit(False))
                            for name in null_cols.values()})


# ----------------------------------------------------------------- C9-C11
def add_race_id(df: DataFrame, year: str = "year", rnd: str = "round",
                name: str = "race_id") -> DataFrame:
    """``{year}_R{round:02d}``."""
    return df.withColumn(name, race_id_col(year, rnd))


def add_days_since_start(df: DataFrame, date_col: str = "session_date",
                         name: str = "days_since_start") -> DataFrame:
    """Whole 24-hour days since the earliest date of the whole table.
    The minimum is a scalar subquery (one aggregate job), not a window."""
    first = df.select(F.min(date_col)).scalar()
    return df.withColumn(name, F.timestamp_diff("DAY", first, F.col(date_col)))


def add_season_progress(df: DataFrame, year: str = "year", rnd: str = "round",
                        name: str = "season_progress") -> DataFrame:
    """C11: (round - min) / (max - min) within the year; 0 for a single
    round.  Min/max per year are an aggregate joined back; AQE broadcasts it by
    its measured bytes."""
    mm = df.groupBy(year).agg(F.min(rnd).alias("__rmin"), F.max(rnd).alias("__rmax"))
    out = df.join(mm, [year], "left")
    prog = F.try_divide((F.col(rnd) - F.col("__rmin")).cast("double"),
                        (F.col("__rmax") - F.col("__rmin")).cast("double"))
    prog = F.when(F.col("__rmax") == F.col("__rmin"), F.lit(0.0)).otherwise(prog)
    return out.withColumn(name, prog).drop("__rmin", "__rmax")


# ---------------------------------------------------------------- C16-C20
def flag_missing_partner(df: DataFrame, group: Sequence[str], kind_col: str,
                         need: str, partner: str, order: Sequence[str],
                         message: str, out: str = "validation_warnings") -> DataFrame:
    """In each group that has a ``need`` row but no ``partner`` row,
    append ``message`` to the FIRST ``need`` row (by ``order``).

    Per-group facts come from one aggregate (partner present? first need
    row's order key) joined back on the salted group keys (see
    :func:`lapdeck.functions.joins.join_back`)."""
    from lapdeck.functions.joins import join_back
    k = F.col(kind_col)
    ordc = struct_order(list(order))
    facts = (df.groupBy(*group)
             .agg(F.coalesce(F.bool_or(k == partner), F.lit(False)).alias("__has_partner"),
                  F.min(F.when(k == need, ordc)).alias("__first_need")))
    j = join_back(df, facts, list(group), "left")
    hit = (k == need) & ~F.col("__has_partner") & (ordc == F.col("__first_need"))
    prev = F.col(out) if out in df.columns else F.lit("")
    return (j.withColumn(out, F.concat(prev, F.when(hit, F.lit(message)).otherwise(F.lit(""))))
            .drop("__has_partner", "__first_need"))


def flag_missing_parts(df: DataFrame, parts: Sequence[tuple[str, str]],
                       when: Column | None = None, template: str = MSG_MISSING_FILES,
                       out: str = "validation_warnings") -> DataFrame:
    """C17: for rows where ``when`` holds (default: any part missing), append
    ``Missing files: a, b; `` listing the missing parts in the given order.
    ``parts`` = [(label, boolean column), ...]."""
    missing = F.concat_ws(", ", *[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(label))
                                  for label, c in parts])
    any_missing = reduce(lambda a, b: a | b,
                         [~F.coalesce(F.col(c), F.lit(False)) for _, c in parts])
    cond = any_missing if when is None else (when & any_missing)
    pre, post = template.split("{}")
    prev = F.col(out) if out in df.columns else F.lit("")
    msg = F.when(cond, F.concat(F.lit(pre), missing, F.lit(post))).otherwise(F.lit(""))
    return df.withColumn(out, F.concat(prev, msg))


def flag_when(df: DataFrame, cond: Column, message: str,
              out: str = "validation_warnings") -> DataFrame:
    """Append a message where a condition holds."""
    prev = F.col(out) if out in df.columns else F.lit("")
    return df.withColumn(out, F.concat(prev, F.when(F.coalesce(cond, F.lit(False)),
                                                    F.lit(message)).otherwise(F.lit(""))))


def flag_duplicates(df: DataFrame, keys: Sequence[str], message: str = MSG_DUPLICATE,
                    passed: str = "validation_passed",
                    out: str = "validation_errors") -> DataFrame:
    """C20: every copy of a duplicated key gets passed=False and the message.
    Duplicate keys come from a pre-aggregated ``groupBy().count()`` joined
    back on salted keys, not from a
    ``count(*) over (partition by keys)`` window (one task per key).  NULL
    keys count as equal, as in ``groupBy``."""
    from lapdeck.functions.joins import join_back
    dups = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
            .filter(F.col("__n") > 1).withColumn("__dup", F.lit(True)))
    j = join_back(df, dups, list(keys), "left").drop("__n")
    is_dup = F.coalesce(F.col("__dup"), F.lit(False))
    prev_ok = F.col(passed) if passed in df.columns else F.lit(True)
    prev = F.col(out) if out in df.columns else F.lit("")
    return j.withColumns({
        passed: prev_ok & ~is_dup,
        out: F.concat(prev, F.when(is_dup, F.lit(message)).otherwise(F.lit(""))),
    }).drop("__dup")


def freshness(df: DataFrame, date_col: str, as_of: Column | str,
              where: Column | None = None, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """One row -- latest date (of the rows matching ``where``), its age in
    whole days at ``as_of`` and whether it is stale (age > max)."""
    src = df if where is None else df.filter(where)
    as_of_c = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    latest = src.agg(F.max(date_col).alias("latest_date"))
    age = F.timestamp_diff("DAY", F.col("latest_date"), as_of_c)
    return latest.select("latest_date", age.alias("age_days"),
                         F.coalesce(age > max_age_days, F.lit(False)).alias("is_stale"))


def verdict(n_rows: Column, error_kinds: Column, warning_kinds: Column) -> list[Column]:
    """passed = no error kinds; score = round(100 * (1 - (0.5 errors +
    0.1 warnings) / max(n, 1)), 2).  Errors / warnings count check KINDS."""
    score = F.round(100.0 * (1 - (error_kinds * 0.5 + warning_kinds * 0.1)
                             / F.greatest(n_rows, F.lit(1))), 2)
    return [(error_kinds == 0).alias("validation_passed"),
            error_kinds.cast("bigint").alias("total_errors"),
            warning_kinds.cast("bigint").alias("total_warnings"),
            score.alias("data_quality_score")]


# ---------------------------------------------------------------- C14 C22
def rollup_summary(df: DataFrame, dim: str, complete: Column,
                   score: Column | None = None) -> DataFrame:
    """C14: per value of ``dim`` and overall (``dim`` NULL, ``is_total``):
    entries, complete, incomplete, complete share %, mean score."""
    aggs = [F.count(F.lit(1)).alias("entries"),
            F.count_if(F.coalesce(complete, F.lit(False))).alias("complete"),
            F.count_if(~F.coalesce(complete, F.lit(False))).alias("incomplete")]
    if score is not None:
        aggs.append(F.avg(score).alias("mean_score"))
    out = df.rollup(dim).agg(*aggs, F.grouping(dim).alias("__g"))
    return out.select(dim, (F.col("__g") == 1).alias("is_total"),
                      "entries", "complete", "incomplete",
                      (F.col("complete") * 100.0 / F.col("entries")).alias("complete_pct"),
                      *(["mean_score"] if score is not None else []))


def breakdown(df: DataFrame, dims: Sequence[str], complete: Column) -> DataFrame:
    """Totals and complete counts per dimension combination, most
    frequent first (the sort is for the report sink)."""
    return (df.groupBy(*dims)
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.coalesce(complete, F.lit(False))).alias("complete"))
            .orderBy(F.col("total").desc(), *dims))


def first_n(df: DataFrame, n: int, order: Sequence[str | Column],
            partition_by: Sequence[str] | None = None) -> DataFrame:
    """C15 / C22 / V3 / S10 preview: first ``n`` rows by ``order``, globally
    (``TakeOrderedAndProject``: per-task top-n then merge) or per partition
    key (``row_number() <= n``; Spark inserts a map-side WindowGroupLimit, so
    every task forwards at most n rows per key)."""
    from pyspark.sql import Window
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    if not partition_by:
        return df.orderBy(*ords).limit(n)
    w = Window.partitionBy(*partition_by).orderBy(*ords)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") <= n).drop("__rn"))


def overflow_count(df: DataFrame, n: int) -> Column:
    """Rows beyond the first n (scalar subquery)."""
    return F.greatest(df.select(F.count(F.lit(1)) - n).scalar(), F.lit(0))


# ------------------------------------------------------------------- C12
def _issue_frames(catalog: DataFrame, race: str, quali: str, keys: Sequence[str]):
    races = catalog.filter(F.col("session") == race)
    quals = catalog.filter(F.col("session") == quali).select(*keys).distinct()
    return {
        "incomplete_races": races.filter(~F.col("is_complete")),
        "races_missing_qualifying": races.join(quals, list(keys), "left_anti"),
        "sessions_with_null_positions": catalog.filter(
            F.coalesce(F.col("has_null_positions"), F.lit(False))),
    }, races


def catalog_issues(catalog: DataFrame, race: str = "Race", quali: str = "Qualifying",
                   keys: Sequence[str] = ("year", "round")) -> DataFrame:
    """One row per issue kind (issue, count), always present -- no race
    at all; incomplete races; races without qualifying (anti-join on year,
    round); sessions with NULL positions.  The affected sessions themselves
    are rows of :func:`catalog_issue_details` (never gathered into one list)."""
    frames, races = _issue_frames(catalog, race, quali, keys)
    parts = [races.agg(F.lit("no_races").alias("issue"),
                       (F.count(F.lit(1)) == 0).cast("bigint").alias("count"))]
    parts += [f.agg(F.lit(name).alias("issue"), F.count(F.lit(1)).alias("count"))
              for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def catalog_issue_details(catalog: DataFrame, race: str = "Race", quali: str = "Qualifying",
                          keys: Sequence[str] = ("year", "round")) -> DataFrame:
    """C12 detail: (issue, year, event, session) for every affected session."""
    frames, _ = _issue_frames(catalog, race, quali, keys)
    return reduce(DataFrame.unionByName,
                  [f.select(F.lit(name).alias("issue"), "year", "event", "session")
                   for name, f in frames.items()])


# -------------------------------------------------------------- assembled
def build_catalog(files: DataFrame, session_info: DataFrame | None = None,
                  results: DataFrame | None = None,
                  keys: Sequence[str] = ("year", "event", "session"),
                  lo: int | None = 2020, hi: int | None = None) -> DataFrame:
    """Manifest -> one row per (year, event, session)."""
    sess = session_files(files, lo, hi)
    cat = completeness(presence_flags(sess, list(keys), "data_type", DATA_TYPES),
                       DATA_TYPES, CRITICAL_TYPES).drop("n_present")
    if session_info is not None:
        cat = attach_first(cat, session_info, list(keys), [*keys],
                           {"session_date": "session_date", "location": "circuit",
                            "total_laps": "total_laps", "event_format": "event_format",
                            "round_number": "round"})
    else:
        cat = cat.withColumns({c: F.lit(None) for c in
                               ("session_date", "circuit", "total_laps", "event_format")})
        cat = cat.withColumn("round", F.lit(None).cast("int"))
    if results is not None:
        cat = quality_metrics(cat, results, list(keys),
                              {"Position": "has_null_positions",
                               "GridPosition": "has_null_grid"})
    else:
        cat = cat.withColumns({"total_drivers": F.lit(None).cast("bigint"),
                               "has_null_positions": F.lit(False),
                               "has_null_grid": F.lit(False)})
    quali = (cat.filter(F.col("session") == "Qualifying").select("year", "round")
             .distinct().withColumn("has_qualifying_data", F.lit(True)))
    cat = cat.join(quali, ["year", "round"], "left").withColumn(
        "has_qualifying_data", F.coalesce(F.col("has_qualifying_data"), F.lit(False)))
    # event_name is the folder's event key; it is kept as ``event`` too, the key of the landed tables
    cat = cat.withColumnRenamed("has_race_control_messages", "has_race_control").withColumns({
        "event_name": F.col("event"), "session_path": F.concat_ws("/", "year", "event", "session", F.lit(""))})
    cat = cat.select(*CATALOG_COLUMNS, "event")
    cat = add_race_id(cat)
    cat = add_days_since_start(cat)
    return add_season_progress(cat)


def validate_catalog(cat: DataFrame, as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(catalog with validation columns, one-row verdict)."""
    v = cat.withColumns({"validation_passed": F.lit(True),
                         "validation_warnings": F.lit(""),
                         "validation_errors": F.lit("")})
    v = flag_missing_partner(v, ["year", "round"], "session", "Race", "Qualifying",
                             ["event", "session"], MSG_MISSING_QUALI)
    v = flag_missing_parts(v, [(t, f"has_{t}") for t in CRITICAL_TYPES],
                           when=F.col("session") == "Race")
    v = flag_when(v, F.col("has_null_positions"), MSG_NULL_POSITIONS)
    v = flag_duplicates(v, ["year", "round", "session"])
    race = F.col("session") == "Race"

    def any_row(cond: Column) -> Column:
        return F.coalesce(F.bool_or(cond), F.lit(False)).cast("int")

    kinds = [F.count(F.lit(1)).alias("n"), any_row(F.col("validation_errors") != "").alias("errors"),
             any_row(race & F.col("validation_warnings").contains(MSG_MISSING_QUALI.strip())).alias("quali"),
             any_row(race & ~F.col("is_complete")).alias("files"), F.max(F.when(race, F.col("session_date"))).alias("latest")]
    facts = v.agg(*kinds)
    stale = F.lit(0)
    if as_of:
        age = F.timestamp_diff("DAY", F.col("latest"), F.lit(as_of).cast("timestamp_ntz"))
        stale = F.coalesce(age > MAX_AGE_DAYS, F.lit(False)).cast("int")
    verdict_df = facts.select(*verdict(F.col("n"), F.col("errors"), F.col("quali") + F.col("files") + stale))
    return v, verdict_df
