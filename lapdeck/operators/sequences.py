"""Sequence features: ordered rows of one entity -> one feature row.

The reference computes ~40 features per (race, driver) from that driver's
laps.  Here the same features come out of a handful of aggregates:

* row-level features (counts, pace, consistency, sectors, position stats,
  stint counts) are ONE ``groupBy(group)`` with map-side partial
  aggregation, so a hot group is pre-aggregated in every task before the
  shuffle;
* order-dependent features (trend index, lap-to-lap position changes, first /
  last position) need a running state.  Instead of one window over the whole
  group (a hot group would then be sorted in one task), rows are split into
  *chunks* -- a monotone bucket of the order key within the group (e.g. the
  day of a timestamp).  Windows run per (group, chunk); each chunk is
  summarised; a small window over the chunk summaries carries the running
  state (prefix sums, last position) across chunk boundaries.  A cell that
  is still hot (``max_chunk_rows``) is cut into equal ranges of the first
  order column.  For bounded groups (laps of one race) ``chunk=None`` puts
  each group in one chunk;
* stint means are a two-level aggregate (group, stint) -> group.

All features are exact.  Percentiles use Spark's exact ``percentile``
(linear interpolation, same as pandas ``quantile``), whose partial state is a
value->count map; groups of more than ``quantile_rows`` values get theirs by rank
selection over counted ranges (:mod:`lapdeck.operators.quantiles`), so no state grows with a group.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapdeck.functions.columns import struct_order
from lapdeck.operators.quantiles import large_groups, selected_quantiles

FAMILIES = ("counts", "identity", "pace", "consistency", "trend", "stints",
            "sectors", "positions")

# Fixed output order of the feature columns (matches the reference's table).
FEATURE_ORDER = (
    "driver_abbreviation", "team_name",
    "total_laps", "valid_laps", "deleted_laps", "invalid_laps",
    "avg_lap_time", "median_lap_time", "best_lap_time", "worst_lap_time",
    "lap_time_range", "pct_05_lap_time", "pct_95_lap_time",
    "lap_time_std", "lap_time_cv", "lap_time_iqr", "seconds_off_best",
    "lap_time_trend", "tire_deg_per_lap", "first_stint_avg", "last_stint_avg",
    "stint_delta",
    "avg_sector1", "avg_sector2", "avg_sector3",
    "best_sector1", "best_sector2", "best_sector3",
    "avg_position", "best_position", "worst_position", "position_changes",
    "net_position_change",
    "num_pit_stops", "num_tire_stints", "avg_stint_length",
    "valid_lap_pct",
)


@dataclass(frozen=True)
class SequenceSpec:
    """Column roles for :func:`sequence_features`.

    ``order`` must be a total order inside a group (add a tie-break column).
    ``chunk`` names a column that is a monotone non-decreasing function of
    ``order`` within a group (e.g. ``date_trunc('day', ts)``); it bounds the
    rows any single window task sees.  ``None`` = one chunk per group.
    """
    group: tuple[str, ...] = ("race_id", "DriverNumber")
    order: tuple[str, ...] = ("LapNumber", "Time")
    measure: str = "LapTimeSeconds"
    lo: float = 60.0
    hi: float = 180.0
    status: str | None = "TrackStatus"
    status_ok: tuple[str, ...] = ("1",)
    deleted: str | None = "Deleted"
    min_valid: int = 5
    number: str | None = "DriverNumber"
    identity: str | None = "Driver"
    team: str | None = "Team"
    stint: str | None = "Stint"
    sectors: tuple[str | None, ...] = ("Sector1Seconds", "Sector2Seconds",
                                       "Sector3Seconds")
    sector_lo: float = 15.0
    sector_hi: float = 60.0
    position: str | None = "Position"
    chunk: str | None = None
    # adaptive split: a (group, chunk) cell with more rows than this is cut at
    # quantiles of the order key into pieces of about this many; None = no split
    max_chunk_rows: int | None = None
    # groups with more valid values than this get their quantiles by rank selection (operators/quantiles.py)
    # instead of ``percentile``, whose buffer grows with a group's distinct values; same results
    quantile_rows: int | None = None
    # None = exact quantiles (pandas' linear interpolation); an int switches
    # to percentile_approx with that accuracy for high-cardinality measures
    quantile_accuracy: int | None = None
    extra: tuple[str, ...] = field(default_factory=tuple)


def valid_predicate(spec: SequenceSpec, columns=None) -> Column:
    """L2: strict bounds, non-null measure, status exactly one of the ok
    values, not deleted (a NULL deleted flag counts as not deleted).  Status
    and deleted rules apply only when the column exists (as in the
    reference)."""
    present = set(columns) if columns is not None else None
    has = lambda c: c and (present is None or c in present)
    m = F.col(spec.measure)
    cond = m.isNotNull() & (m > F.lit(spec.lo)) & (m < F.lit(spec.hi))
    if has(spec.status):
        cond = cond & F.col(spec.status).isin(list(spec.status_ok))
    if has(spec.deleted):
        cond = cond & ~F.coalesce(F.col(spec.deleted), F.lit(False))
    return F.coalesce(cond, F.lit(False))


def _null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def sequence_features(df: DataFrame, spec: SequenceSpec = SequenceSpec(),
                      families: tuple[str, ...] | None = None) -> DataFrame:
    """One row per group with the requested feature families (default all).

    Groups with fewer than ``spec.min_valid`` valid rows are dropped (L3).
    """
    fams = set(FAMILIES if families is None else families)
    unknown = fams - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown feature families: {sorted(unknown)}")
    g = list(spec.group)
    cols = set(df.columns)
    has = lambda c: c is not None and c in cols

    ordc = struct_order(list(spec.order))
    valid = valid_predicate(spec, df.columns)
    vt = F.when(F.col("__valid"), F.col(spec.measure))

    needed = set(g) | set(spec.order) | {spec.measure}
    for c in (spec.status, spec.deleted, spec.number, spec.identity, spec.team,
              spec.stint, spec.position, spec.chunk, *spec.sectors, *spec.extra):
        if has(c):
            needed.add(c)
    base = df.select(*[c for c in df.columns if c in needed]).withColumn("__valid", valid)

    want_trend = "trend" in fams
    want_pos = "positions" in fams and has(spec.position)
    # The only full shuffle of the rows: on (group, chunk) for the running
    # state of the ordered features.  All other aggregates read the
    # (column-pruned) scan directly with map-side partial aggregation.
    windowed = _windowed(base, spec, want_trend, want_pos) if (want_trend or want_pos) else None

    if windowed is not None and fams <= {"trend", "positions"}:
        # everything requested comes from the chunk summaries: one pass
        out = _ordered_features(windowed, spec, want_trend, want_pos, standalone=True)
        if "positions" in fams:
            out = out.withColumns({
                "position_changes": F.coalesce(F.col("position_changes"),
                                               F.lit(0).cast("bigint")),
                "net_position_change": F.coalesce(F.col("net_position_change"),
                                                  F.lit(0.0))})
        return out.select(*g, *[c for c in FEATURE_ORDER if c in out.columns])

    if "stints" in fams and fams <= {"stints", "counts"} and has(spec.stint):
        return _stints_and_counts(base, spec, fams, has(spec.deleted))

    # ---------------------------------------------------------- row level
    aggs: list[Column] = [F.count_if(F.col("__valid")).alias("valid_laps")]
    if "counts" in fams:
        aggs += [
            F.count(F.lit(1)).alias("total_laps"),
            (F.count_if(F.coalesce(F.col(spec.deleted), F.lit(False)))
             if has(spec.deleted) else F.lit(0).cast("bigint")).alias("deleted_laps"),
        ]
    if "identity" in fams:
        fallback = (F.concat(F.lit("#"), F.col(spec.number).cast("string"))
                    if has(spec.number) else F.lit(None).cast("string"))
        ident = (F.coalesce(F.min_by(F.col(spec.identity), ordc), fallback)
                 if has(spec.identity) else fallback)
        team = (F.min_by(F.col(spec.team), ordc) if has(spec.team)
                else F.lit("Unknown"))
        aggs += [ident.alias("driver_abbreviation"), team.alias("team_name")]
    if "pace" in fams or "consistency" in fams:
        aggs += [F.avg(vt).alias("avg_lap_time"), F.min(vt).alias("best_lap_time")]
    # All quantiles share ONE exact percentile state (one value->count map).
    qs: list[float] = []
    if "pace" in fams:
        qs += [0.5, 0.05, 0.95]
        aggs.append(F.max(vt).alias("worst_lap_time"))
    if "consistency" in fams:
        qs += [0.75, 0.25]
        aggs.append(F.stddev_samp(vt).alias("lap_time_std"))
    large = None
    if qs:
        if spec.quantile_rows and spec.quantile_accuracy is None:
            large = large_groups(base, g, vt, spec.quantile_rows)
        if large is not None:  # fewer than rows / quantile_rows groups: broadcast by their measured size
            base = _null_safe_join(base, large.withColumn("__large", F.lit(True)), g, "left")
        here = vt if large is None else F.when(F.col("__large").isNull(), vt)
        probs = F.array(*[F.lit(q) for q in qs])
        qagg = (F.percentile(here, probs) if spec.quantile_accuracy is None
                else F.percentile_approx(vt, probs, spec.quantile_accuracy).cast("array<double>"))
        aggs.append(qagg.alias("__q"))
    if "sectors" in fams:
        for i, sc in enumerate(spec.sectors, 1):
            if has(sc):
                s = F.col(sc)
                sv = F.when(F.col("__valid") & (s > spec.sector_lo)
                            & (s < spec.sector_hi), s)
                aggs += [F.avg(sv).alias(f"avg_sector{i}"),
                         F.min(sv).alias(f"best_sector{i}")]
            else:
                aggs += [F.lit(None).cast("double").alias(f"avg_sector{i}"),
                         F.lit(None).cast("double").alias(f"best_sector{i}")]
    if "positions" in fams:
        if has(spec.position):
            p = F.col(spec.position)
            aggs += [F.avg(p).cast("double").alias("avg_position"),
                     F.min(p).cast("double").alias("best_position"),
                     F.max(p).cast("double").alias("worst_position")]
        else:
            aggs += [F.lit(None).cast("double").alias(x)
                     for x in ("avg_position", "best_position", "worst_position")]
    if "stints" in fams or "counts" in fams:
        if "counts" not in fams:
            aggs.append(F.count(F.lit(1)).alias("total_laps"))
    if "stints" in fams:
        if has(spec.stint):
            aggs.append(F.count_distinct(F.col(spec.stint)).alias("num_tire_stints"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias("num_tire_stints"))

    main = (base.groupBy(*g).agg(*aggs)
            .filter(F.col("valid_laps") >= spec.min_valid))

    if large is not None:
        rows = base.filter(F.col("__large")).select(*g, vt.alias("__vt"))
        picked = selected_quantiles(rows, g, "__vt", qs, spec.quantile_rows).withColumnRenamed("q", "__picked")
        main = _null_safe_join(main, picked, g, "left").withColumn("__q", F.coalesce("__picked", "__q")).drop("__picked")

    qname = {0.5: "median_lap_time", 0.05: "pct_05_lap_time",
             0.95: "pct_95_lap_time", 0.75: "__q75", 0.25: "__q25"}
    if qs:
        main = main.withColumns({qname[q]: F.col("__q")[i] for i, q in enumerate(qs)})
    derived: dict[str, Column] = {}
    if "counts" in fams:
        derived["invalid_laps"] = F.col("total_laps") - F.col("valid_laps")
        derived["valid_lap_pct"] = F.try_divide(F.col("valid_laps").cast("double"),
                                                F.col("total_laps"))
    if "pace" in fams:
        derived["lap_time_range"] = F.col("worst_lap_time") - F.col("best_lap_time")
    if "consistency" in fams:
        derived["lap_time_cv"] = F.when(
            F.col("avg_lap_time") > 0,
            F.col("lap_time_std") / F.col("avg_lap_time")).otherwise(F.lit(0.0))
        derived["lap_time_iqr"] = F.col("__q75") - F.col("__q25")
        derived["seconds_off_best"] = F.col("avg_lap_time") - F.col("best_lap_time")
    if "stints" in fams:
        # no stint column at all -> 0 pit stops; a column of NULLs -> -1 (kept)
        derived["num_pit_stops"] = (F.col("num_tire_stints") - 1 if has(spec.stint)
                                    else F.lit(0).cast("bigint"))
        derived["avg_stint_length"] = F.try_divide(
            F.col("total_laps").cast("double"),
            F.when(F.col("num_tire_stints") > 0, F.col("num_tire_stints")))
    if derived:
        main = main.withColumns(derived)

    out = main
    # ------------------------------------------------------------- stints
    if "stints" in fams:
        if has(spec.stint):
            per_stint = (base.filter(F.col("__valid") & F.col(spec.stint).isNotNull())
                         .groupBy(*g, spec.stint)
                         .agg(F.avg(F.col(spec.measure)).alias("__stint_avg")))
            firstlast = (per_stint.groupBy(*g).agg(
                F.min_by("__stint_avg", F.col(spec.stint)).alias("first_stint_avg"),
                F.max_by("__stint_avg", F.col(spec.stint)).alias("last_stint_avg"))
                .withColumn("stint_delta",
                            F.col("last_stint_avg") - F.col("first_stint_avg")))
            out = _null_safe_join(out, firstlast, g, "left")
        else:
            out = out.withColumns({c: F.lit(None).cast("double") for c in
                                   ("first_stint_avg", "last_stint_avg", "stint_delta")})

    # ------------------------------------------- order-dependent (chunked)
    if windowed is not None:
        out = _null_safe_join(out, _ordered_features(windowed, spec, want_trend, want_pos),
                              g, "left")
    if "positions" in fams and not has(spec.position):
        out = out.withColumns({"position_changes": F.lit(0).cast("bigint"),
                               "net_position_change": F.lit(0.0)})
    if want_pos:
        out = out.withColumns({
            "position_changes": F.coalesce(F.col("position_changes"),
                                           F.lit(0).cast("bigint")),
            "net_position_change": F.coalesce(F.col("net_position_change"),
                                              F.lit(0.0)),
        })

    feats = [c for c in FEATURE_ORDER if c in out.columns]
    if "valid_laps" in feats and "counts" not in fams:
        feats.remove("valid_laps")
    if "total_laps" in feats and "counts" not in fams:
        feats.remove("total_laps")
    return out.select(*g, *feats)


def _stints_and_counts(base: DataFrame, spec: SequenceSpec, fams: set[str],
                       has_deleted: bool) -> DataFrame:
    """L5 + L9 + L14 in ONE two-level aggregate: per (group, stint) partial
    sums, then per group -- no second scan and no join."""
    g = list(spec.group)
    st = F.col(spec.stint)
    valid = F.col("__valid")
    deleted = F.coalesce(F.col(spec.deleted), F.lit(False)) if has_deleted else F.lit(False)
    per = base.groupBy(*g, spec.stint).agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(valid).alias("__nv"),
        F.count_if(deleted).alias("__nd"),
        F.sum(F.when(valid, F.col(spec.measure))).alias("__sv"))
    has_avg = F.col(spec.stint).isNotNull() & (F.col("__nv") > 0)
    stint_avg = F.col("__sv") / F.col("__nv")
    out = (per.groupBy(*g).agg(
        F.sum("__rows").alias("total_laps"), F.sum("__nv").alias("valid_laps"),
        F.sum("__nd").alias("deleted_laps"),
        F.count(st).alias("num_tire_stints"),
        F.min_by(stint_avg, F.when(has_avg, st)).alias("first_stint_avg"),
        F.max_by(stint_avg, F.when(has_avg, st)).alias("last_stint_avg"))
        .filter(F.col("valid_laps") >= spec.min_valid))
    out = out.withColumns({
        "stint_delta": F.col("last_stint_avg") - F.col("first_stint_avg"),
        "num_pit_stops": F.col("num_tire_stints") - 1,
        "avg_stint_length": F.try_divide(F.col("total_laps").cast("double"),
                                         F.when(F.col("num_tire_stints") > 0,
                                                F.col("num_tire_stints"))),
        "invalid_laps": F.col("total_laps") - F.col("valid_laps"),
        "valid_lap_pct": F.try_divide(F.col("valid_laps").cast("double"), F.col("total_laps")),
    })
    keep = [c for c in FEATURE_ORDER if c in out.columns]
    if "counts" not in fams:
        keep = [c for c in keep if c not in ("total_laps", "valid_laps", "deleted_laps",
                                             "invalid_laps", "valid_lap_pct")]
    return out.select(*g, *keep)


SAMPLES_PER_CUT = 32


def _split_hot_cells(rows: DataFrame, spec: SequenceSpec) -> DataFrame:
    """Cut (group, chunk) cells holding more than ``max_chunk_rows`` rows into sub-ranges of about that many rows.

    The cuts are quantiles of the full order key, tie-break included, so a burst at one time is
    cut as well: about ``SAMPLES_PER_CUT`` keys per ``max_chunk_rows`` rows, chosen by their hash, are
    sorted, and every ``SAMPLES_PER_CUT``-th is a cut.  Cell sizes and samples come from one partial aggregate; only the hot
    cells are kept and broadcast back, so the rows are not shuffled for this.  The broadcast has a
    proven bound: there are fewer than rows / max_chunk_rows cells and as many cuts.  The sub-range index never
    decreases along the order, which is all the carry-over needs; results are exact for any cuts.
    """
    g = list(spec.group)
    if not spec.max_chunk_rows:
        return rows.withColumn("__chunk", F.col("__chunk0")).drop("__chunk0")
    key = F.struct(*spec.order)
    sampled = F.pmod(F.xxhash64(*spec.order), F.lit(spec.max_chunk_rows)) < SAMPLES_PER_CUT
    hot = (rows.groupBy(*g, "__chunk0")
           .agg(F.count(F.lit(1)).alias("__n"), F.sort_array(F.collect_list(F.when(sampled, key))).alias("__keys"))
           .filter(F.col("__n") > spec.max_chunk_rows))
    cuts = F.filter("__keys", lambda x, i: i % SAMPLES_PER_CUT == SAMPLES_PER_CUT - 1)
    hot = hot.select(*g, "__chunk0", cuts.alias("__cuts"))
    j = _null_safe_join(rows, F.broadcast(hot), [*g, "__chunk0"], "left")
    sub = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= key)), F.lit(0))
    return (j.withColumn("__chunk", F.struct(F.col("__chunk0").alias("c"), sub.cast("long").alias("s")))
            .drop("__chunk0", "__cuts"))


def _windowed(base: DataFrame, spec: SequenceSpec, want_trend: bool,
              want_pos: bool) -> DataFrame:
    """Running state inside each (group, chunk): index among valid rows and
    the previous non-null position."""
    g = list(spec.group)
    chunk = F.col(spec.chunk) if spec.chunk else F.lit(0)
    rows = _split_hot_cells(base.withColumn("__chunk0", chunk), spec)
    w = Window.partitionBy(*g, "__chunk").orderBy(*spec.order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    win_cols: dict[str, Column] = {}
    if want_trend:
        win_cols["__lidx"] = F.sum(F.col("__valid").cast("long")).over(upto) - 1
    if want_pos:
        win_cols["__prev_pos"] = F.last(F.col(spec.position), ignorenulls=True).over(before)
    return rows.withColumns(win_cols)


def _ordered_features(rows: DataFrame, spec: SequenceSpec, want_trend: bool,
                      want_pos: bool, standalone: bool = False) -> DataFrame:
    """Trend slope (L8), position changes (L12) and net change (L13) from
    per-chunk summaries of the windowed rows.

    ``standalone`` also derives the minimum-support filter (L3) and the
    position statistics (L11) from the chunk summaries, so a request for
    only these families needs no second pass over the input."""
    g = list(spec.group)
    ordc = struct_order(list(spec.order))

    chunk_aggs: list[Column] = []
    if standalone:
        chunk_aggs.append(F.count_if(F.col("__valid")).alias("__nv"))
        if want_pos:
            p0 = F.col(spec.position)
            chunk_aggs += [F.sum(p0).alias("__psum"), F.min(p0).alias("__pmin"),
                           F.max(p0).alias("__pmax")]
    if want_trend:
        vt = F.when(F.col("__valid"), F.col(spec.measure))
        chunk_aggs += [
            F.count_if(F.col("__valid")).alias("__m"),
            F.sum(vt).alias("__sy"),
            F.sum(vt * F.col("__lidx")).alias("__sxy"),
        ]
    if want_pos:
        p = F.col(spec.position)
        key = F.when(p.isNotNull(), ordc)
        chunk_aggs += [
            F.count_if(p != F.col("__prev_pos")).alias("__chg"),
            F.min_by(p, key).alias("__first_pos"),
            F.max_by(p, key).alias("__last_pos"),
            F.count(p).alias("__npos"),
        ]
    chunks = rows.groupBy(*g, "__chunk").agg(*chunk_aggs)

    cw = Window.partitionBy(*g).orderBy("__chunk")
    cbefore = cw.rowsBetween(Window.unboundedPreceding, -1)
    carry: dict[str, Column] = {}
    if want_trend:
        carry["__off"] = F.coalesce(F.sum("__m").over(cbefore), F.lit(0))
    if want_pos:
        prev_last = F.last("__last_pos", ignorenulls=True).over(cbefore)
        carry["__bchg"] = F.coalesce((F.col("__first_pos") != prev_last).cast("int"),
                                     F.lit(0))
    chunks = chunks.withColumns(carry)

    final: list[Column] = []
    if standalone:
        final.append(F.sum("__nv").alias("__NV"))
        if want_pos:
            final += [F.sum("__psum").alias("__PSUM"), F.min("__pmin").alias("best_position"),
                      F.max("__pmax").alias("worst_position")]
    if want_trend:
        final += [F.sum("__m").alias("__M"), F.sum("__sy").alias("__SY"),
                  F.sum(F.col("__sxy") + F.col("__off") * F.col("__sy")).alias("__SXY")]
    if want_pos:
        final += [
            (F.sum("__chg") + F.sum("__bchg")).cast("bigint").alias("position_changes"),
            F.min_by("__first_pos", F.when(F.col("__first_pos").isNotNull(),
                                           F.col("__chunk"))).alias("__fp"),
            F.max_by("__last_pos", F.when(F.col("__last_pos").isNotNull(),
                                          F.col("__chunk"))).alias("__lp"),
            F.sum("__npos").alias("__np"),
        ]
    res = chunks.groupBy(*g).agg(*final)
    outc: dict[str, Column] = {}
    if want_trend:
        m = F.col("__M").cast("double")
        # OLS slope of y on x = 0..m-1:  (Sxy - xbar*Sy) / (m(m^2-1)/12)
        slope = F.when(m >= 2, (F.col("__SXY") - (m - 1) / 2 * F.col("__SY"))
                       / (m * (m * m - 1) / 12))
        outc["lap_time_trend"] = slope
        outc["tire_deg_per_lap"] = slope
    if want_pos:
        outc["net_position_change"] = F.when(
            F.col("__np") >= 2, (F.col("__fp") - F.col("__lp")).cast("double")
        ).otherwise(F.lit(0.0))
    if standalone and want_pos:
        outc["avg_position"] = F.try_divide(F.col("__PSUM").cast("double"),
                                            F.col("__np").cast("double"))
        outc["best_position"] = F.col("best_position").cast("double")
        outc["worst_position"] = F.col("worst_position").cast("double")
    res = res.withColumns(outc)
    if standalone:
        res = res.filter(F.col("__NV") >= spec.min_valid)
    keep = [c for c in ("avg_position", "best_position", "worst_position",
                        "lap_time_trend", "tire_deg_per_lap", "position_changes",
                        "net_position_change") if c in res.columns]
    return res.select(*g, *keep)


def dataset_statistics(features: DataFrame) -> DataFrame:
    """One row -- groups, mean laps per group, mean valid share, mean and
    std of the group mean measure."""
    return features.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg("total_laps").alias("avg_laps_per_driver"),
        F.avg("valid_lap_pct").alias("avg_valid_lap_pct"),
        F.avg("avg_lap_time").alias("mean_avg_lap_time"),
        F.stddev_samp("avg_lap_time").alias("std_avg_lap_time"),
    )
