"""Sequence features (L1-L21) on ``events``.

Mapping of roles: race = ISO week of ``ts`` (as a date), driver = ``user_id``,
lap order = (ts, event_id), lap time = ``value`` with valid bounds 1 < v < 100,
track status ok = event types other than ``error``, stint = weekday of ``ts``
(0 = Monday), position = ``$.k`` of ``props`` with every tenth value (k % 10
= 0) made NULL so the missing-position path runs, sectors = (value, k,
value / 2).  Chunk (the unit of one window task) = the hour of ``ts``: a user holding a
third of all rows is split into hourly slices; an hour that still holds more
than 2M rows is cut further at quantiles of the lap order (``max_chunk_rows``);
results are exact for any split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.functions.columns import normalise_missing
from lapdeck.operators.quantiles import selected_quantiles
from lapdeck.operators.sequences import SequenceSpec, dataset_statistics, sequence_features
from lapdeck.plans.registry import register, rounded, table

OK_TYPES = ("click", "purchase", "signup", "view")

EVENTS_SPEC = SequenceSpec(
    group=("week", "user_id"),
    order=("ts", "event_id"),
    measure="value",
    lo=1.0,
    hi=100.0,
    status="event_type",
    status_ok=OK_TYPES,
    deleted=None,
    min_valid=5,
    number="user_id",
    identity=None,
    team="event_type",
    stint="stint",
    sectors=("value", "k_d", "half_value"),
    position="pos",
    chunk="chunk",
    max_chunk_rows=2_000_000,
    quantile_rows=1_000_000,
)


def prepared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = normalise_missing(table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        F.to_date(F.date_trunc("week", "ts")).alias("week"),
        "user_id", "ts", "event_id", "value", "event_type",
        F.weekday("ts").alias("stint"),
        k.cast("double").alias("k_d"),
        (F.col("value") / 2).alias("half_value"),
        F.when(k % 10 != 0, k).cast("double").alias("pos"),
        F.date_trunc("hour", "ts").alias("chunk"),
    )


def features(spark: SparkSession, sf_dir: str, families=None) -> DataFrame:
    return sequence_features(prepared_events(spark, sf_dir), EVENTS_SPEC, families)


_EV = """
WITH ev AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id, ts, event_id,
         value, event_type,
         isodow(ts) - 1 AS stint,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k_d,
         value / 2 AS half_value,
         CAST(CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 <> 0
                   THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS DOUBLE) AS pos,
         COALESCE(value > 1 AND value < 100
                  AND event_type IN ('click', 'purchase', 'signup', 'view'), FALSE) AS valid
  FROM events
),
supported AS (
  SELECT week, user_id FROM ev GROUP BY week, user_id
  HAVING count(*) FILTER (WHERE valid) >= 5
)
"""

SQL_PACE = _EV + """
SELECT e.week, e.user_id,
  CAST(count(*) AS BIGINT) AS total_laps,
  CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS valid_laps,
  CAST(0 AS BIGINT) AS deleted_laps,
  CAST(count(*) - count(*) FILTER (WHERE valid) AS BIGINT) AS invalid_laps,
  round(avg(value) FILTER (WHERE valid), 6) AS avg_lap_time,
  round(quantile_cont(value, 0.5) FILTER (WHERE valid), 6) AS median_lap_time,
  round(min(value) FILTER (WHERE valid), 6) AS best_lap_time,
  round(max(value) FILTER (WHERE valid), 6) AS worst_lap_time,
  round(max(value) FILTER (WHERE valid) - min(value) FILTER (WHERE valid), 6) AS lap_time_range,
  round(quantile_cont(value, 0.05) FILTER (WHERE valid), 6) AS pct_05_lap_time,
  round(quantile_cont(value, 0.95) FILTER (WHERE valid), 6) AS pct_95_lap_time,
  round(count(*) FILTER (WHERE valid) / count(*), 6) AS valid_lap_pct
FROM ev e JOIN supported s ON e.week = s.week AND e.user_id = s.user_id
GROUP BY e.week, e.user_id
"""


@register("seq_features_pace", SQL_PACE, "L1 L2 L3 L5 L6 L18")
def q_pace(spark, sf_dir):
    f = features(spark, sf_dir, ("counts", "pace"))
    return rounded(f.select("week", "user_id", "total_laps", "valid_laps", "deleted_laps",
                            "invalid_laps", "avg_lap_time", "median_lap_time",
                            "best_lap_time", "worst_lap_time", "lap_time_range",
                            "pct_05_lap_time", "pct_95_lap_time", "valid_lap_pct"))


SQL_CONSISTENCY = _EV + """
SELECT week, user_id,
  round(stddev_samp(value), 6) AS lap_time_std,
  round(CASE WHEN avg(value) > 0 THEN stddev_samp(value) / avg(value) ELSE 0 END, 6) AS lap_time_cv,
  round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS lap_time_iqr,
  round(avg(value) - min(value), 6) AS seconds_off_best
FROM ev JOIN supported USING (week, user_id) WHERE valid
GROUP BY week, user_id
"""


@register("quantiles_by_rank", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS q05, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, round(quantile_cont(l_extendedprice, 0.95), 6) AS q95
FROM lineitem GROUP BY l_returnflag""", "L6 L7 (quantiles of groups that hold a third of all rows)")
def q_quantiles_by_rank(spark, sf_dir):
    """Each flag has about a third of all lines: its quantiles come from counted ranges, no task gets its values."""
    q = selected_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.25, 0.5, 0.75, 0.95], small_rows=10_000)
    return rounded(q.select("l_returnflag", *[F.col("q")[i].alias(n) for i, n in enumerate(("q05", "q25", "q50", "q75", "q95"))]))


@register("seq_features_consistency", SQL_CONSISTENCY, "L2 L3 L7")
def q_consistency(spark, sf_dir):
    f = features(spark, sf_dir, ("consistency",))
    return rounded(f.select("week", "user_id", "lap_time_std", "lap_time_cv",
                            "lap_time_iqr", "seconds_off_best"))


SQL_TREND = _EV + """,
idx AS (
  SELECT week, user_id, value,
         row_number() OVER (PARTITION BY week, user_id ORDER BY ts, event_id) - 1 AS x
  FROM ev WHERE valid
)
SELECT week, user_id,
  round(regr_slope(value, x), 6) AS lap_time_trend,
  round(regr_slope(value, x), 6) AS tire_deg_per_lap
FROM idx JOIN supported USING (week, user_id)
GROUP BY week, user_id
"""


@register("seq_trend", SQL_TREND, "L8")
def q_trend(spark, sf_dir):
    f = features(spark, sf_dir, ("trend",))
    return rounded(f.select("week", "user_id", "lap_time_trend", "tire_deg_per_lap"))


SQL_STINTS = _EV + """,
stint_avg AS (
  SELECT week, user_id, stint, avg(value) AS a
  FROM ev WHERE valid AND stint IS NOT NULL GROUP BY week, user_id, stint
),
fl AS (
  SELECT week, user_id, arg_min(a, stint) AS first_stint_avg,
         arg_max(a, stint) AS last_stint_avg
  FROM stint_avg GROUP BY week, user_id
),
cnt AS (
  SELECT week, user_id, count(*) AS n, count(DISTINCT stint) AS ns
  FROM ev GROUP BY week, user_id
)
SELECT c.week, c.user_id,
  round(fl.first_stint_avg, 6) AS first_stint_avg,
  round(fl.last_stint_avg, 6) AS last_stint_avg,
  round(fl.last_stint_avg - fl.first_stint_avg, 6) AS stint_delta,
  CAST(c.ns - 1 AS BIGINT) AS num_pit_stops,
  CAST(c.ns AS BIGINT) AS num_tire_stints,
  round(CASE WHEN c.ns > 0 THEN c.n / c.ns END, 6) AS avg_stint_length
FROM cnt c JOIN supported s ON c.week = s.week AND c.user_id = s.user_id
LEFT JOIN fl ON c.week = fl.week AND c.user_id = fl.user_id
"""


@register("seq_stints", SQL_STINTS, "L9 L14")
def q_stints(spark, sf_dir):
    f = features(spark, sf_dir, ("stints",))
    return rounded(f.select("week", "user_id", "first_stint_avg", "last_stint_avg",
                            "stint_delta", "num_pit_stops", "num_tire_stints",
                            "avg_stint_length"))


SQL_POSITIONS = _EV + """,
seq AS (
  SELECT week, user_id, pos,
         row_number() OVER (PARTITION BY week, user_id ORDER BY ts, event_id) AS rn,
         lag(pos IGNORE NULLS) OVER (PARTITION BY week, user_id ORDER BY ts, event_id) AS prev
  FROM ev
)
SELECT s.week, s.user_id,
  round(avg(pos), 6) AS avg_position,
  round(min(pos), 6) AS best_position,
  round(max(pos), 6) AS worst_position,
  CAST(count(*) FILTER (WHERE pos IS NOT NULL AND prev IS NOT NULL AND pos <> prev) AS BIGINT)
    AS position_changes,
  round(CASE WHEN count(pos) >= 2
             THEN arg_min(pos, rn) FILTER (WHERE pos IS NOT NULL)
                - arg_max(pos, rn) FILTER (WHERE pos IS NOT NULL)
             ELSE 0 END, 6) AS net_position_change
FROM seq s JOIN supported u ON s.week = u.week AND s.user_id = u.user_id
GROUP BY s.week, s.user_id
"""


@register("seq_positions", SQL_POSITIONS, "L11 L12 L13")
def q_positions(spark, sf_dir):
    f = features(spark, sf_dir, ("positions",))
    return rounded(f.select("week", "user_id", "avg_position", "best_position",
                            "worst_position", "position_changes", "net_position_change"))


SQL_SECTOR = _EV + """
SELECT week, user_id,
  round(avg(value) FILTER (WHERE valid AND value > 15 AND value < 60), 6) AS avg_sector1,
  round(avg(k_d) FILTER (WHERE valid AND k_d > 15 AND k_d < 60), 6) AS avg_sector2,
  round(avg(half_value) FILTER (WHERE valid AND half_value > 15 AND half_value < 60), 6) AS avg_sector3,
  round(min(value) FILTER (WHERE valid AND value > 15 AND value < 60), 6) AS best_sector1,
  round(min(k_d) FILTER (WHERE valid AND k_d > 15 AND k_d < 60), 6) AS best_sector2,
  round(min(half_value) FILTER (WHERE valid AND half_value > 15 AND half_value < 60), 6) AS best_sector3
FROM ev JOIN supported USING (week, user_id)
GROUP BY week, user_id
"""


@register("seq_sector", SQL_SECTOR, "L10")
def q_sector(spark, sf_dir):
    f = features(spark, sf_dir, ("sectors",))
    return rounded(f.select("week", "user_id", "avg_sector1", "avg_sector2", "avg_sector3",
                            "best_sector1", "best_sector2", "best_sector3"))


SQL_IDENTITY = _EV + """
SELECT week, user_id,
  '#' || CAST(user_id AS VARCHAR) AS driver_abbreviation,
  event_type AS team_name
FROM (SELECT ev.*, row_number() OVER (PARTITION BY week, user_id ORDER BY ts, event_id) AS rn
      FROM ev) JOIN supported USING (week, user_id)
WHERE rn = 1
"""


@register("seq_identity", SQL_IDENTITY, "L4")
def q_identity(spark, sf_dir):
    f = features(spark, sf_dir, ("identity",))
    return f.select("week", "user_id", "driver_abbreviation", "team_name")


SQL_VALID_PCT = _EV + """
SELECT week, user_id, round(count(*) FILTER (WHERE valid) / count(*), 6) AS valid_lap_pct
FROM ev GROUP BY week, user_id HAVING count(*) FILTER (WHERE valid) >= 5
"""


@register("seq_valid_pct", SQL_VALID_PCT, "L18")
def q_valid_pct(spark, sf_dir):
    f = features(spark, sf_dir, ("counts",))
    return rounded(f.select("week", "user_id", "valid_lap_pct"))


SQL_STATS = _EV + """,
f AS (
  SELECT week, user_id, count(*) AS total_laps,
         count(*) FILTER (WHERE valid) / count(*) AS valid_lap_pct,
         avg(value) FILTER (WHERE valid) AS avg_lap_time
  FROM ev GROUP BY week, user_id HAVING count(*) FILTER (WHERE valid) >= 5
)
SELECT CAST(count(*) AS BIGINT) AS n_groups,
  round(avg(total_laps), 6) AS avg_laps_per_driver,
  round(avg(valid_lap_pct), 6) AS avg_valid_lap_pct,
  round(avg(avg_lap_time), 6) AS mean_avg_lap_time,
  round(stddev_samp(avg_lap_time), 6) AS std_avg_lap_time
FROM f
"""


@register("seq_stats", SQL_STATS, "L20")
def q_stats(spark, sf_dir):
    return rounded(dataset_statistics(features(spark, sf_dir, ("counts", "pace"))))


SQL_ALL = _EV + """,
agg AS (
  SELECT week, user_id,
    count(*) AS total_laps, count(*) FILTER (WHERE valid) AS valid_laps,
    avg(value) FILTER (WHERE valid) AS avg_lap_time,
    quantile_cont(value, 0.5) FILTER (WHERE valid) AS median_lap_time,
    min(value) FILTER (WHERE valid) AS best_lap_time,
    max(value) FILTER (WHERE valid) AS worst_lap_time,
    quantile_cont(value, 0.05) FILTER (WHERE valid) AS pct_05_lap_time,
    quantile_cont(value, 0.95) FILTER (WHERE valid) AS pct_95_lap_time,
    stddev_samp(value) FILTER (WHERE valid) AS lap_time_std,
    quantile_cont(value, 0.75) FILTER (WHERE valid)
      - quantile_cont(value, 0.25) FILTER (WHERE valid) AS lap_time_iqr,
    avg(value) FILTER (WHERE valid AND value > 15 AND value < 60) AS avg_sector1,
    avg(k_d) FILTER (WHERE valid AND k_d > 15 AND k_d < 60) AS avg_sector2,
    avg(half_value) FILTER (WHERE valid AND half_value > 15 AND half_value < 60) AS avg_sector3,
    min(value) FILTER (WHERE valid AND value > 15 AND value < 60) AS best_sector1,
    min(k_d) FILTER (WHERE valid AND k_d > 15 AND k_d < 60) AS best_sector2,
    min(half_value) FILTER (WHERE valid AND half_value > 15 AND half_value < 60) AS best_sector3,
    avg(pos) AS avg_position, min(pos) AS best_position, max(pos) AS worst_position,
    count(DISTINCT stint) AS ns
  FROM ev GROUP BY week, user_id HAVING count(*) FILTER (WHERE valid) >= 5
),
idx AS (
  SELECT week, user_id, value,
         row_number() OVER (PARTITION BY week, user_id ORDER BY ts, event_id) - 1 AS x
  FROM ev WHERE valid
),
trend AS (SELECT week, user_id, regr_slope(value, x) AS slope FROM idx GROUP BY week, user_id),
stint_avg AS (
  SELECT week, user_id, stint, avg(value) AS a
  FROM ev WHERE valid AND stint IS NOT NULL GROUP BY week, user_id, stint
),
fl AS (
  SELECT week, user_id, arg_min(a, stint) AS f, arg_max(a, stint) AS l
  FROM stint_avg GROUP BY week, user_id
),
seq AS (
  SELECT week, user_id, pos, event_type,
    row_number() OVER (PARTITION BY week, user_id ORDER BY ts, event_id) AS rn,
    lag(pos IGNORE NULLS) OVER (PARTITION BY week, user_id ORDER BY ts, event_id) AS prev
  FROM ev
),
posf AS (
  SELECT week, user_id,
    count(*) FILTER (WHERE pos IS NOT NULL AND prev IS NOT NULL AND pos <> prev) AS changes,
    CASE WHEN count(pos) >= 2
         THEN arg_min(pos, rn) FILTER (WHERE pos IS NOT NULL)
            - arg_max(pos, rn) FILTER (WHERE pos IS NOT NULL) ELSE 0 END AS net,
    arg_min(event_type, rn) AS team_name
  FROM seq GROUP BY week, user_id
)
SELECT a.week, a.user_id,
  '#' || CAST(a.user_id AS VARCHAR) AS driver_abbreviation, p.team_name,
  CAST(a.total_laps AS BIGINT) AS total_laps, CAST(a.valid_laps AS BIGINT) AS valid_laps,
  CAST(0 AS BIGINT) AS deleted_laps, CAST(a.total_laps - a.valid_laps AS BIGINT) AS invalid_laps,
  round(a.avg_lap_time, 6) AS avg_lap_time, round(a.median_lap_time, 6) AS median_lap_time,
  round(a.best_lap_time, 6) AS best_lap_time, round(a.worst_lap_time, 6) AS worst_lap_time,
  round(a.worst_lap_time - a.best_lap_time, 6) AS lap_time_range,
  round(a.pct_05_lap_time, 6) AS pct_05_lap_time, round(a.pct_95_lap_time, 6) AS pct_95_lap_time,
  round(a.lap_time_std, 6) AS lap_time_std,
  round(CASE WHEN a.avg_lap_time > 0 THEN a.lap_time_std / a.avg_lap_time ELSE 0 END, 6)
    AS lap_time_cv,
  round(a.lap_time_iqr, 6) AS lap_time_iqr,
  round(a.avg_lap_time - a.best_lap_time, 6) AS seconds_off_best,
  round(t.slope, 6) AS lap_time_trend, round(t.slope, 6) AS tire_deg_per_lap,
  round(fl.f, 6) AS first_stint_avg, round(fl.l, 6) AS last_stint_avg,
  round(fl.l - fl.f, 6) AS stint_delta,
  round(a.avg_sector1, 6) AS avg_sector1, round(a.avg_sector2, 6) AS avg_sector2,
  round(a.avg_sector3, 6) AS avg_sector3, round(a.best_sector1, 6) AS best_sector1,
  round(a.best_sector2, 6) AS best_sector2, round(a.best_sector3, 6) AS best_sector3,
  round(a.avg_position, 6) AS avg_position, round(a.best_position, 6) AS best_position,
  round(a.worst_position, 6) AS worst_position,
  CAST(p.changes AS BIGINT) AS position_changes, round(p.net, 6) AS net_position_change,
  CAST(a.ns - 1 AS BIGINT) AS num_pit_stops, CAST(a.ns AS BIGINT) AS num_tire_stints,
  round(CASE WHEN a.ns > 0 THEN a.total_laps / a.ns END, 6) AS avg_stint_length,
  round(a.valid_laps / a.total_laps, 6) AS valid_lap_pct
FROM agg a
LEFT JOIN trend t ON a.week = t.week AND a.user_id = t.user_id
LEFT JOIN fl ON a.week = fl.week AND a.user_id = fl.user_id
LEFT JOIN posf p ON a.week = p.week AND a.user_id = p.user_id
"""


@register("seq_features_all", SQL_ALL, "L1-L18 (full feature row)")
def q_all(spark, sf_dir):
    return rounded(features(spark, sf_dir))


SQL_FEATURE_CHECKS = """
WITH f AS (
  SELECT strftime(week, '%Y-%m-%d') AS race_id, CAST(user_id AS VARCHAR) AS driver_number, *
  FROM (""" + SQL_ALL + """)
)
SELECT * FROM (
  SELECT 'rows_per_race' AS "check", 'warning' AS severity, CAST(count(*) AS DOUBLE) AS measured,
    printf('[%d, %d]', count(DISTINCT race_id) * 15, count(DISTINCT race_id) * 25) AS "limit",
    count(*) BETWEEN count(DISTINCT race_id) * 15 AND count(DISTINCT race_id) * 25 AS ok
  FROM f
  UNION ALL
  SELECT 'avg_lap_time_range', 'warning',
    CAST(count(*) FILTER (WHERE avg_lap_time < 60 OR avg_lap_time > 180) AS DOUBLE), '[60, 180]',
    count(*) FILTER (WHERE avg_lap_time < 60 OR avg_lap_time > 180) = 0
  FROM f
  UNION ALL
  SELECT 'avg_lap_time_nulls', 'warning',
    round(COALESCE(avg(CASE WHEN avg_lap_time IS NULL THEN 1.0 ELSE 0.0 END), 0), 6), '<= 0.1',
    COALESCE(avg(CASE WHEN avg_lap_time IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.1
  FROM f
  UNION ALL
  SELECT 'best_lap_time_nulls', 'warning',
    round(COALESCE(avg(CASE WHEN best_lap_time IS NULL THEN 1.0 ELSE 0.0 END), 0), 6), '<= 0.1',
    COALESCE(avg(CASE WHEN best_lap_time IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.1
  FROM f
  UNION ALL
  SELECT 'low_valid_share', 'warning',
    CAST(count(*) FILTER (WHERE valid_lap_pct < 0.5) AS DOUBLE), '[0.5, ]',
    count(*) FILTER (WHERE valid_lap_pct < 0.5) = 0
  FROM f
  UNION ALL
  SELECT 'duplicate_race_driver', 'error', CAST(COALESCE(sum(n), 0) AS DOUBLE), '0',
    COALESCE(sum(n), 0) = 0
  FROM (SELECT count(*) AS n FROM f GROUP BY race_id, driver_number HAVING count(*) > 1)
  UNION ALL
  SELECT 'required_columns', 'error', 0.0, 'missing: ', TRUE)
"""


@register("seq_output_checks", SQL_FEATURE_CHECKS, "L19 (output checks of the feature table)")
def q_output_checks(spark, sf_dir):
    from lapdeck.plans.motorsport import features_output_checks
    f = features(spark, sf_dir).select(
        F.date_format("week", "yyyy-MM-dd").alias("race_id"),
        F.col("user_id").cast("string").alias("driver_number"), "*")
    return rounded(features_output_checks(f))
