"""S1 S3 S7 S9 and the three jobs on files landed from the driver's tables.

All ``orders`` and ``lineitem`` rows are landed as session objects (``year/event/session/type.parquet``) in the shared folder; the
gate, the manifest, the fan-in and the jobs then read that bucket.

* A session is (year and quarter of o_orderdate, o_orderpriority): ``Race``, ``Qualifying``, ``Practice 1``, ``Practice 2``, and ``Shakedown``,
  a name that the catalog doesn't know; one Qualifying is landed as ``Sprint Qualifying``.
* results: an order is a driver's row.  By quarter, times are seconds, nanoseconds or text, and positions are doubles, integers or text: three
  versions of the writer.
* laps: the lines of the orders of Race and Qualifying.  session_info: one row per session, its date a timestamp, nanoseconds or text.
* One results object is no Parquet file, one lacks a column; each year has a ``season_schedule`` and a ``circuits`` object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.functions.columns import event_key
from lapdeck.operators.catalog import parse_manifest
from lapdeck.plans import motorsport as M
from lapdeck.plans.registry import register, rounded, table
from lapdeck.session import scratch_path
from lapdeck.sources.landed import landed_gate, read_landed, season_gate
from lapdeck.sources.manifest import child_prefixes, list_files
from lapdeck.sources.sinks import write_objects
from lapdeck.streaming.refresh import start_catalog_state

ROLES = {"1-URGENT": "Race", "2-HIGH": "Qualifying", "3-MEDIUM": "Practice 1", "4-NOT SPECIFIED": "Practice 2", "5-LOW": "Shakedown"}
BROKEN, THIN, SPRINT = (1995, 1, "Practice 1"), (1996, 2, "Practice 2"), (1996, 3)
KEYS = ["year", "event", "session"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("o_orderpriority"))
    sprint = (role == "Qualifying") & (F.year("o_orderdate") == SPRINT[0]) & (F.quarter("o_orderdate") == SPRINT[1])
    return table(spark, sf_dir, "orders").withColumns({
        "year": F.year("o_orderdate"), "round": F.quarter("o_orderdate"), "event": event_key(F.concat(F.lit("Round "), F.quarter("o_orderdate"), F.lit(" GP"))),
        "session": F.when(sprint, "Sprint Qualifying").otherwise(role)})


def _text(seconds: Column) -> Column:
    """Seconds as duration text."""
    return F.format_string("%d days %02d:%02d:%09.6f", F.floor(seconds / 86400), F.floor(seconds / 3600) % 24, F.floor(seconds / 60) % 60, seconds % 60)


def _as_version(df: DataFrame, k: int, seconds: list[str], counts: list[str]) -> DataFrame:
    """The rows as the ``k``-th of three versions of a writer stores them; it wrote the quarters with remainder ``k`` by 3."""
    if k == 0:
        return df
    if k == 1:
        return df.withColumns({c: F.round(F.col(c) * 1e6).cast("bigint") * 1000 for c in seconds} | {c: F.col(c).cast("int") for c in counts})
    return df.withColumns({c: _text(F.col(c)) for c in seconds} | {c: F.col(c).cast("string") for c in counts})


def _is(session: tuple) -> Column:
    return (F.col("year") == session[0]) & (F.col("round") == session[1]) & (F.col("session") == session[2])


def _results(orders: DataFrame) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    place = (1 + k % 20).cast("double")
    return orders.select(*KEYS, "round", F.col("o_custkey").cast("string").alias("DriverNumber"), F.concat(F.lit("D"), F.col("o_custkey") % 1000).alias("Abbreviation"),
                         F.concat(F.lit("driver_"), "o_custkey").alias("DriverId"), F.concat(F.lit("Driver "), "o_custkey").alias("FullName"),
                         F.concat(F.lit("Team "), F.col("o_custkey") % 10).alias("TeamName"), F.concat(F.lit("team_"), F.col("o_custkey") % 10).alias("TeamId"),
                         F.col("o_orderstatus").alias("TeamColor"), F.when(k % 50 != 0, place).alias("Position"),
                         F.when(k % 3 == 0, "R").otherwise((1 + k % 20).cast("string")).alias("ClassifiedPosition"),
                         F.when(k % 40 != 0, 1 + F.col("o_custkey") % 20).cast("double").alias("GridPosition"), (price / 1000).alias("Q1"),
                         F.when(k % 2 == 0, price / 2000).alias("Q2"), F.when(k % 4 == 0, price / 5000).alias("Q3"), F.when(k % 3 != 0, price / 10).alias("Time"),
                         F.when(k % 3 == 0, "Engine").when(k % 7 == 0, "+1 Lap").otherwise("Finished").alias("Status"), price.alias("Points"), (k % 70).cast("double").alias("Laps"))


def _run_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of the orders of Race and Qualifying, in the columns that their laps are made of."""
    rows = lines.join(orders.filter(F.col("session").isin("Race", "Qualifying")), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*KEYS, "round", "o_custkey", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                       "l_returnflag")


def _laps(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, "round", F.col("o_custkey").cast("string").alias("DriverNumber"),
                       F.when(F.col("l_orderkey") % 10 != 0, F.concat(F.lit("D"), F.col("o_custkey") % 1000)).alias("Driver"),
                       F.concat(F.lit("Team "), F.col("l_orderkey") % 10).alias("Team"), F.col("l_linenumber").cast("double").alias("LapNumber"),
                       (F.col("l_orderkey") + F.col("l_extendedprice") / 1e6).alias("Time"), (F.col("l_quantity") + 60).alias("LapTime"),
                       (10 + F.col("l_quantity") / 2).alias("Sector1Time"), (20 + F.col("l_tax") * 100).alias("Sector2Time"), (12 + F.col("l_discount") * 100).alias("Sector3Time"),
                       F.when(F.col("l_partkey") % 11 != 0, 1 + F.floor(F.col("l_linenumber") / 3)).cast("double").alias("Stint"),
                       F.when(F.col("l_partkey") % 9 == 0, "4").otherwise("1").alias("TrackStatus"),
                       F.when(F.col("l_suppkey") % 10 != 0, 1 + F.col("l_suppkey") % 20).cast("double").alias("Position"),
                       F.when(F.col("l_partkey") % 7 != 0, F.col("l_returnflag") == "R").alias("Deleted"))


def _land(spark: SparkSession, sf_dir: str) -> str:
    """Every order and line as landed objects, by one write per table and version.  Lines meet their orders once, for all versions."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _LANDED:
        return _LANDED[known]
    root = scratch_path(spark, "landed")
    orders = _orders(spark, sf_dir)
    write_objects(orders.filter(_is(BROKEN)), root, "results", fmt="text", shape=lambda o: _results(o).select(*KEYS, "DriverNumber"))
    write_objects(orders.filter(_is(THIN)), root, "results", shape=lambda o: _results(o).drop("Status", "round"))
    lines = M.stored(_run_lines(orders, table(spark, sf_dir, "lineitem")))
    for k in range(3):
        version = F.col("round") % 3 == k
        write_objects(orders.filter(~_is(BROKEN) & ~_is(THIN) & version), root, "results",
                      shape=lambda o, k=k: _as_version(_results(o), k, ["Q1", "Q2", "Q3", "Time"], ["Position", "GridPosition"]).drop("round"))
        write_objects(lines.filter(version), root, "laps", shape=lambda x, k=k: _as_version(_laps(x), k, ["LapTime", "Time"], []).drop("round"))
    info = orders.groupBy(*KEYS, "round").agg(F.min("o_orderdate").cast("timestamp_ntz").alias("session_date"), F.count("*").cast("int").alias("total_laps"))
    info = M.stored(info).withColumns({"round_number": F.col("round"), "location": F.concat(F.lit("circuit_"), "round"), "event_format": F.lit("conventional")})
    dates = [F.col("session_date"), F.unix_micros(F.col("session_date").cast("timestamp")) * 1000, F.col("session_date").cast("string")]
    for k, date in enumerate(dates):
        write_objects(info.filter(F.col("round") % 3 == k).withColumn("session_date", date).drop("round"), root, "session_info")
    season = M.stored(orders.groupBy("year", "round", "event").agg(F.min("o_orderdate").alias("EventDate")))
    season = season.select("year", F.col("year").alias("Season"), F.col("round").alias("RoundNumber"), F.col("event").alias("EventName"),
                           F.concat(F.lit("circuit_"), "round").alias("Location"), F.lit("X").alias("Country"), F.lit("conventional").alias("EventFormat"), "EventDate")
    write_objects(season, root, "season_schedule", keys=("year",))
    circuits = season.select("year", F.col("RoundNumber").alias("circuitId"), F.col("Location").alias("circuitName"), F.col("Location").alias("locality"), F.col("Country").alias("country"))
    write_objects(circuits.filter("year % 2 = 0"), root, "circuits", keys=("year",))
    write_objects(circuits.filter("year % 2 = 1").drop("circuitId", "country"), root, "circuits", keys=("year",))
    _LANDED[known] = root
    return root


#: Buckets landed by an application, by folder of the given tables; the queries read the same one.
_LANDED: dict[tuple[str, str], str] = {}
_CATALOGS: dict[str, str] = {}

_ROWS = """
o AS (SELECT *, year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS round, 'round_' || quarter(o_orderdate) || '_gp' AS event,
             CASE WHEN o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1996 AND quarter(o_orderdate) = 3 THEN 'Sprint Qualifying'
                  WHEN o_orderpriority = '1-URGENT' THEN 'Race' WHEN o_orderpriority = '2-HIGH' THEN 'Qualifying' WHEN o_orderpriority = '3-MEDIUM' THEN 'Practice 1'
                  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Practice 2' ELSE 'Shakedown' END AS session FROM orders),
r AS (SELECT year, round, event, session, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS run, CAST(o_custkey AS VARCHAR) AS driver, o_custkey, o_orderkey AS k, o_orderstatus, o_totalprice AS price,
             CASE WHEN o_orderkey % 50 <> 0 THEN 1 + o_orderkey % 20 END::DOUBLE AS position, CASE WHEN o_orderkey % 40 <> 0 THEN 1 + o_custkey % 20 END::DOUBLE AS grid,
             round(o_totalprice / 1000, 6) AS q1, CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice / 2000, 6) END AS q2,
             CASE WHEN o_orderkey % 4 = 0 THEN round(o_totalprice / 5000, 6) END AS q3, o_orderdate FROM o),
n AS (SELECT year, round, event, session, count(*) AS rows, min(o_orderdate)::TIMESTAMP AS first_date, bool_or(position IS NULL) AS null_position,
             bool_or(grid IS NULL) AS null_grid, bool_or(run) AS run FROM r GROUP BY ALL),
gate AS (SELECT *, CASE WHEN (year, round, session) = (1995, 1, 'Practice 1') THEN 'unreadable'
                        WHEN (year, round, session) = (1996, 2, 'Practice 2') THEN 'missing columns' END AS reason, session IN ('Race', 'Qualifying') AND run AS laps FROM n),
cat AS (SELECT *, reason IS NULL AND null_position AS has_null, laps AS is_complete FROM gate WHERE session <> 'Shakedown')
"""


@register("scan_gated", f"""WITH {_ROWS}
SELECT 'results' AS data_type, year, event, session, reason IS NULL AS ok, reason, CASE WHEN reason = 'missing columns' THEN 'Status' ELSE '' END AS missing,
       CASE WHEN reason IS NULL THEN rows END::BIGINT AS rows FROM gate
UNION ALL SELECT 'season_schedule', year, NULL, NULL, TRUE, NULL, '', count(DISTINCT round) FROM o GROUP BY year
UNION ALL SELECT 'circuits', year, NULL, NULL, year % 2 = 0, CASE WHEN year % 2 = 1 THEN 'missing columns' END, CASE WHEN year % 2 = 1 THEN 'circuitId, country' ELSE '' END,
       CASE WHEN year % 2 = 0 THEN count(DISTINCT round) END FROM o GROUP BY year""",
          "S1 S3 (file gate: sessions, schedules, circuits)")
def q_scan_gated(spark, sf_dir):
    root = _land(spark, sf_dir)
    per = [F.bool_and("ok").alias("ok"), F.min("reason").alias("reason"), F.array_join(F.max("missing_columns"), ", ").alias("missing"), F.sum("rows").alias("rows")]
    out = landed_gate(spark, root, "results").groupBy(F.lit("results").alias("data_type"), *KEYS).agg(*per)
    for kind in ("season_schedule", "circuits"):
        gate = season_gate(spark, root, kind).groupBy(F.lit(kind).alias("data_type"), "year").agg(*per)
        out = out.unionByName(gate.withColumns({"event": F.lit(None).cast("string"), "session": F.lit(None).cast("string")}))
    return out


@register("fan_in_sessions", f"""WITH {_ROWS}
SELECT r.year, r.event, r.session, driver, position, grid, round(price, 6) AS points, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3,
       CASE WHEN k % 3 <> 0 THEN round(price / 10, 6) END AS time
FROM r JOIN gate g ON r.year = g.year AND r.event = g.event AND r.session = g.session WHERE g.reason IS NULL""", "S1 S2 S9 (fan-in of landed objects of three versions)")
def q_fan_in(spark, sf_dir):
    rows = read_landed(spark, _land(spark, sf_dir), "results")
    return rounded(rows.select(*KEYS, F.col("DriverNumber").alias("driver"), F.col("Position").alias("position"), F.col("GridPosition").alias("grid"),
                               F.col("Points").alias("points"), F.col("Q1").alias("q1"), F.col("Q2").alias("q2"), F.col("Q3").alias("q3"), F.col("Time").alias("time")))


@register("manifest_parse", f"""WITH {_ROWS}
SELECT CAST(year AS VARCHAR) AS year_part, event, session, t AS data_type, TRUE AS landed
FROM gate, (VALUES ('results'), ('session_info'), ('laps')) x(t) WHERE t <> 'laps' OR laps
UNION ALL SELECT DISTINCT CAST(year AS VARCHAR), NULL, NULL, t, TRUE FROM o, (VALUES ('season_schedule'), ('circuits')) x(t)""", "S7 (manifest keys)")
def q_manifest_parse(spark, sf_dir):
    root = _land(spark, sf_dir)
    files = parse_manifest(list_files(spark, root, glob="part-*"), root)
    return files.groupBy("year_part", "event", "session", "data_type").agg((F.count("*") > 0).alias("landed"))


@register("manifest_prefixes", f"""WITH {_ROWS} SELECT DISTINCT year || '/' || event AS prefix FROM gate""", "S7 (child prefixes)")
def q_manifest_prefixes(spark, sf_dir):
    root = _land(spark, sf_dir)
    files = parse_manifest(list_files(spark, root, glob="part-*"), root)
    return child_prefixes(files.filter(F.col("event").isNotNull()), 2)


_CATALOG_SQL = f"""WITH {_ROWS}, m AS (SELECT min(first_date) AS d0 FROM cat WHERE BOUNDS),
y AS (SELECT year, min(round) AS a, max(round) AS z FROM cat WHERE BOUNDS GROUP BY year)
SELECT c.year, round, event AS event_name, 'circuit_' || round AS circuit, session, first_date AS session_date, c.year || '/' || event || '/' || session || '/' AS session_path,
       TRUE AS has_results, laps AS has_laps, FALSE AS has_weather, TRUE AS has_session_info, FALSE AS has_track_status, FALSE AS has_session_status,
       FALSE AS has_race_control, CASE WHEN reason IS NULL THEN rows END::BIGINT AS total_drivers, rows::INT AS total_laps, 'conventional' AS event_format,
       EXISTS (SELECT 1 FROM cat q WHERE q.session = 'Qualifying' AND q.year = c.year AND q.round = c.round) AS has_qualifying_data, has_null AS has_null_positions,
       reason IS NULL AND null_grid AS has_null_grid, is_complete, round(CASE WHEN laps THEN 3 ELSE 2 END / 7.0 * 100, 6) AS completeness_score,
       event, c.year || '_R' || lpad(CAST(round AS VARCHAR), 2, '0') AS race_id, date_diff('day', m.d0, first_date)::BIGINT AS days_since_start,
       round(CASE WHEN a = z THEN 0 ELSE (round - a) / (z - a) END, 6) AS season_progress
FROM cat c JOIN y ON c.year = y.year, m WHERE c.BOUNDS"""


def _catalog(spark: SparkSession, sf_dir: str, **years) -> DataFrame:
    """The catalog of the bucket, built anew."""
    return M.catalog_job(spark, _land(spark, sf_dir), **({"first_year": None} | years), glob="part-*").data


def _stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as the later jobs read it: stored once per bucket."""
    root = _land(spark, sf_dir)
    if root not in _CATALOGS:
        out = scratch_path(spark, "catalog")
        M.catalog_job(spark, root, first_year=None, glob="part-*", out=out)
        _CATALOGS[root] = f"{out}/race_catalog.parquet"
    return spark.read.parquet(_CATALOGS[root])


@register("catalog_build", _CATALOG_SQL.replace("c.BOUNDS", "TRUE").replace("BOUNDS", "TRUE"), "C1-C11 (catalog of landed objects, every column)")
def q_catalog_build(spark, sf_dir):
    cat = _catalog(spark, sf_dir)
    return rounded(cat.drop("validation_passed", "validation_warnings", "validation_errors"))


@register("catalog_years", _CATALOG_SQL.replace("c.BOUNDS", "c.year BETWEEN 1996 AND 1998").replace("BOUNDS", "year BETWEEN 1996 AND 1998"), "C1 (year bounds of the catalog)")
def q_catalog_years(spark, sf_dir):
    cat = _catalog(spark, sf_dir, first_year=1996, last_year=1998)
    return rounded(cat.drop("validation_passed", "validation_warnings", "validation_errors"))


@register("race_results", f"""WITH {_ROWS},
q AS (SELECT * FROM r WHERE session = 'Qualifying'),
d AS (SELECT year, round, first_date FROM gate WHERE session = 'Race')
SELECT r.year || '_R' || lpad(CAST(r.round AS VARCHAR), 2, '0') AS race_id, r.year, r.round, r.event AS event_name, 'circuit_' || r.round AS circuit, d.first_date AS race_date,
       r.driver AS driver_number, 'driver_' || r.o_custkey AS driver_id, 'D' || (r.o_custkey % 1000) AS driver_abbreviation, 'Driver ' || r.o_custkey AS full_name,
       'team_' || (r.o_custkey % 10) AS team_id, 'Team ' || (r.o_custkey % 10) AS team_name, r.o_orderstatus AS team_color,
       round(q.q1, 6) AS q1, round(q.q2, 6) AS q2, round(q.q3, 6) AS q3, round(q.q1, 6) AS q1_seconds, round(q.q2, 6) AS q2_seconds, round(q.q3, 6) AS q3_seconds,
       r.grid AS grid_position, r.position AS finish_position, CASE WHEN r.k % 3 = 0 THEN 'R' ELSE CAST(1 + r.k % 20 AS VARCHAR) END AS classified_position,
       r.grid - r.position AS position_gain, round(r.price, 6) AS points, (r.k % 70)::DOUBLE AS laps_completed,
       CASE WHEN r.k % 3 = 0 THEN 'Engine' WHEN r.k % 7 = 0 THEN '+1 Lap' ELSE 'Finished' END AS status,
       CASE WHEN r.k % 3 <> 0 THEN round(r.price / 10, 6) END AS race_time, CASE WHEN r.k % 3 <> 0 THEN round(r.price / 10, 6) END AS race_time_seconds,
       r.k % 3 <> 0 AS finished_race, r.k % 3 = 0 AS dnf, COALESCE(r.position <= 10, FALSE) AS finished_top10
FROM r JOIN d ON r.year = d.year AND r.round = d.round LEFT JOIN q ON q.year = r.year AND q.round = r.round AND q.driver = r.driver
WHERE r.session = 'Race'""", "R1-R11 (results job on landed objects, every column)")
def q_race_results(spark, sf_dir):
    root = _land(spark, sf_dir)
    out = M.race_results_job(spark, root, _stored_catalog(spark, sf_dir)).data
    return rounded(out.drop("BroadcastName"))


@register("race_results_first", f"""WITH {_ROWS},
first AS (SELECT year, round FROM gate WHERE session = 'Race' ORDER BY year, round LIMIT 5)
SELECT r.year || '_R' || lpad(CAST(r.round AS VARCHAR), 2, '0') AS race_id, count(*) AS drivers FROM r JOIN first f ON r.year = f.year AND r.round = f.round
LEFT JOIN r q ON q.session = 'Qualifying' AND q.year = r.year AND q.round = r.round AND q.driver = r.driver
WHERE r.session = 'Race' GROUP BY ALL""", "R1 (the first races of the catalog)")
def q_race_results_first(spark, sf_dir):
    out = M.race_results_job(spark, _land(spark, sf_dir), _stored_catalog(spark, sf_dir), first_n=5).data.select("race_id", "driver_number", "q1_seconds")
    return out.groupBy("race_id").agg(F.count("*").alias("drivers"))


@register("qualifying_warnings", f"""WITH {_ROWS},
q AS (SELECT * FROM r WHERE session = 'Qualifying'),
j AS (SELECT r.*, q.q1 AS t FROM r LEFT JOIN q ON q.year = r.year AND q.round = r.round AND q.driver = r.driver WHERE r.session = 'Race')
SELECT year || '_R' || lpad(CAST(round AS VARCHAR), 2, '0') AS race_id, count(t) = 0 AS missing_qualifying, count(*) FILTER (WHERE t IS NULL) AS drivers_without_q1
FROM j GROUP BY year, round""", "R4 (qualifying warnings)")
def q_qualifying_warnings(spark, sf_dir):
    return M.race_results_job(spark, _land(spark, sf_dir), _stored_catalog(spark, sf_dir)).extra["warnings"]


_LAPS_SQL = f"""WITH {_ROWS},
l AS (SELECT r.year, r.round, r.event, r.o_custkey, CASE WHEN l_orderkey % 10 <> 0 THEN 'D' || (r.o_custkey % 1000) END AS name, 'Team ' || (l_orderkey % 10) AS team,
             l_linenumber AS lap, l_orderkey + l_extendedprice / 1e6 AS time, 60 + l_quantity AS t, 10 + l_quantity / 2 AS s1, 20 + l_tax * 100 AS s2, 12 + l_discount * 100 AS s3,
             CASE WHEN l_partkey % 11 <> 0 THEN 1 + l_linenumber // 3 END AS stint, CASE WHEN l_suppkey % 10 <> 0 THEN 1 + l_suppkey % 20 END::DOUBLE AS pos,
             COALESCE(l_partkey % 7 <> 0 AND l_returnflag = 'R', FALSE) AS deleted, l_partkey % 9 <> 0 AS clear
      FROM o r JOIN lineitem ON l_orderkey = r.o_orderkey WHERE r.session = 'Race'),
v AS (SELECT *, t > 60 AND t < 180 AND clear AND NOT deleted AS valid, row_number() OVER (PARTITION BY year, round, o_custkey ORDER BY lap, time) AS rn,
             lag(pos IGNORE NULLS) OVER (PARTITION BY year, round, o_custkey ORDER BY lap, time) AS prev FROM l),
idx AS (SELECT year, round, o_custkey, t, row_number() OVER (PARTITION BY year, round, o_custkey ORDER BY lap, time) - 1 AS x FROM v WHERE valid),
slope AS (SELECT year, round, o_custkey, regr_slope(t, x) AS slope FROM idx GROUP BY ALL),
per_stint AS (SELECT year, round, o_custkey, stint, avg(t) AS a FROM v WHERE valid AND stint IS NOT NULL GROUP BY ALL),
fl AS (SELECT year, round, o_custkey, arg_min(a, stint) AS f, arg_max(a, stint) AS z FROM per_stint GROUP BY ALL),
a AS (SELECT year, round, event, o_custkey, arg_min(team, rn) AS team, max(name) FILTER (WHERE rn = 1) AS name, count(*) AS total, count(*) FILTER (WHERE valid) AS nv,
             count(*) FILTER (WHERE deleted) AS deleted, avg(t) FILTER (WHERE valid) AS avg_t, min(t) FILTER (WHERE valid) AS best, max(t) FILTER (WHERE valid) AS worst,
             quantile_cont(t, [0.05, 0.25, 0.5, 0.75, 0.95]) FILTER (WHERE valid) AS q, stddev_samp(t) FILTER (WHERE valid) AS sd,
             avg(s1) FILTER (WHERE valid AND s1 > 15 AND s1 < 60) AS as1, avg(s2) FILTER (WHERE valid AND s2 > 15 AND s2 < 60) AS as2,
             avg(s3) FILTER (WHERE valid AND s3 > 15 AND s3 < 60) AS as3, min(s1) FILTER (WHERE valid AND s1 > 15 AND s1 < 60) AS bs1,
             min(s2) FILTER (WHERE valid AND s2 > 15 AND s2 < 60) AS bs2, min(s3) FILTER (WHERE valid AND s3 > 15 AND s3 < 60) AS bs3,
             avg(pos) AS ap, min(pos) AS bp, max(pos) AS wp, count(*) FILTER (WHERE pos IS NOT NULL AND prev IS NOT NULL AND pos <> prev) AS changes,
             CASE WHEN count(pos) >= 2 THEN arg_min(pos, rn) FILTER (WHERE pos IS NOT NULL) - arg_max(pos, rn) FILTER (WHERE pos IS NOT NULL) ELSE 0 END AS net,
             count(DISTINCT stint) AS ns
      FROM v GROUP BY ALL HAVING count(*) FILTER (WHERE valid) >= 5)
SELECT a.year || '_R' || lpad(CAST(a.round AS VARCHAR), 2, '0') AS race_id, a.year, a.round, a.event AS event_name, 'circuit_' || a.round AS circuit, g.first_date AS race_date,
       CAST(a.o_custkey AS VARCHAR) AS driver_number, COALESCE(name, '#' || a.o_custkey) AS driver_abbreviation, team AS team_name, total::BIGINT AS total_laps,
       nv::BIGINT AS valid_laps, deleted::BIGINT AS deleted_laps, (total - nv)::BIGINT AS invalid_laps, round(avg_t, 6) AS avg_lap_time, round(q[3], 6) AS median_lap_time,
       round(best, 6) AS best_lap_time, round(worst, 6) AS worst_lap_time, round(worst - best, 6) AS lap_time_range, round(q[1], 6) AS pct_05_lap_time,
       round(q[5], 6) AS pct_95_lap_time, round(sd, 6) AS lap_time_std, round(CASE WHEN avg_t > 0 THEN sd / avg_t ELSE 0 END, 6) AS lap_time_cv,
       round(q[4] - q[2], 6) AS lap_time_iqr, round(avg_t - best, 6) AS seconds_off_best, round(slope, 6) AS lap_time_trend, round(slope, 6) AS tire_deg_per_lap,
       round(f, 6) AS first_stint_avg, round(z, 6) AS last_stint_avg, round(z - f, 6) AS stint_delta, round(as1, 6) AS avg_sector1, round(as2, 6) AS avg_sector2,
       round(as3, 6) AS avg_sector3, round(bs1, 6) AS best_sector1, round(bs2, 6) AS best_sector2, round(bs3, 6) AS best_sector3, round(ap, 6) AS avg_position,
       bp AS best_position, wp AS worst_position, changes::BIGINT AS position_changes, round(net, 6)::DOUBLE AS net_position_change, (ns - 1)::BIGINT AS num_pit_stops,
       ns::BIGINT AS num_tire_stints, round(CASE WHEN ns > 0 THEN total / ns END, 6) AS avg_stint_length, round(nv / total, 6) AS valid_lap_pct
FROM a JOIN gate g ON g.session = 'Race' AND g.year = a.year AND g.round = a.round
LEFT JOIN slope ON slope.year = a.year AND slope.round = a.round AND slope.o_custkey = a.o_custkey
LEFT JOIN fl ON fl.year = a.year AND fl.round = a.round AND fl.o_custkey = a.o_custkey"""


@register("lap_features", _LAPS_SQL, "L1-L18 (lap-feature job on landed objects, every column)")
def q_lap_features(spark, sf_dir):
    return rounded(M.lap_features_job(spark, _land(spark, sf_dir), _stored_catalog(spark, sf_dir)).data)


@register("catalog_issues", f"WITH {_ROWS}" + """
SELECT 'no_races' AS issue, (count(*) FILTER (WHERE session = 'Race') = 0)::BIGINT AS count FROM cat
UNION ALL SELECT 'incomplete_races', count(*) FILTER (WHERE session = 'Race' AND NOT is_complete) FROM cat
UNION ALL SELECT 'races_missing_qualifying', count(*) FROM cat r WHERE session = 'Race' AND NOT EXISTS (
  SELECT 1 FROM cat q WHERE q.session = 'Qualifying' AND q.year = r.year AND q.round = r.round)
UNION ALL SELECT 'sessions_with_null_positions', count(*) FILTER (WHERE has_null) FROM cat""", "C12 (catalog issues)")
def q_catalog_issues(spark, sf_dir):
    from lapdeck.operators.catalog import catalog_issues
    return catalog_issues(_stored_catalog(spark, sf_dir))


@register("catalog_issue_details", f"WITH {_ROWS}" + """
SELECT 'incomplete_races' AS issue, year, event, session FROM cat WHERE session = 'Race' AND NOT is_complete
UNION ALL SELECT 'races_missing_qualifying', year, event, session FROM cat r WHERE session = 'Race' AND NOT EXISTS (
  SELECT 1 FROM cat q WHERE q.session = 'Qualifying' AND q.year = r.year AND q.round = r.round)
UNION ALL SELECT 'sessions_with_null_positions', year, event, session FROM cat WHERE has_null""", "C12 (sessions with issues)")
def q_catalog_issue_details(spark, sf_dir):
    from lapdeck.operators.catalog import catalog_issue_details
    return catalog_issue_details(_stored_catalog(spark, sf_dir))


_WARNED = f"""WITH {_ROWS},
val AS (SELECT *, CASE WHEN session = 'Race' AND NOT EXISTS (SELECT 1 FROM cat q WHERE q.session = 'Qualifying' AND q.year = r.year AND q.round = r.round)
                       THEN 'Missing qualifying session; ' ELSE '' END
                  || CASE WHEN has_null THEN 'Contains null positions (may be DNFs); ' ELSE '' END AS warnings FROM cat r)
"""


@register("catalog_warnings", _WARNED + """
SELECT year, event AS event_name, session, TRUE AS validation_passed, warnings AS validation_warnings, '' AS validation_errors FROM val""", "C16 C17 C18 C20 (validated catalog)")
def q_catalog_warnings(spark, sf_dir):
    return _stored_catalog(spark, sf_dir).select("year", "event_name", "session", "validation_passed", "validation_warnings", "validation_errors")


@register("catalog_flagged", _WARNED + "SELECT year, round, event AS event_name, session, warnings AS validation_warnings FROM val WHERE warnings <> ''", "C22 (rows with warnings or errors)")
def q_catalog_flagged(spark, sf_dir):
    flagged = M.report_tables(_stored_catalog(spark, sf_dir))["flagged"]
    return flagged.select("year", "round", "event_name", "session", "validation_warnings")


@register("catalog_first_warned", _WARNED + """SELECT year, round, session FROM val WHERE warnings <> ''
ORDER BY year, round, session LIMIT 20""", "C22 (first warned rows)")
def q_catalog_first_warned(spark, sf_dir):
    return M.report_tables(_stored_catalog(spark, sf_dir))["first_warned"].select("year", "round", "session")


@register("catalog_statistics", f"WITH {_ROWS}" + """
SELECT count(*) AS total_sessions, count(*) FILTER (WHERE is_complete) AS complete_sessions, count(*) FILTER (WHERE NOT is_complete) AS incomplete_sessions,
       round(avg(CASE WHEN is_complete THEN 3 ELSE 2 END / 7.0 * 100), 2) AS mean_completeness, count(*) FILTER (WHERE session = 'Race') AS races,
       count(*) FILTER (WHERE session LIKE 'Practice%') AS practice_sessions FROM cat""", "C15 (build statistics)")
def q_catalog_statistics(spark, sf_dir):
    return M.build_statistics(_stored_catalog(spark, sf_dir))


@register("catalog_summary", f"WITH {_ROWS}" + """
SELECT year, year IS NULL AS is_total, count(*) AS entries, count(*) FILTER (WHERE is_complete) AS complete, count(*) FILTER (WHERE NOT is_complete) AS incomplete,
       round(count(*) FILTER (WHERE is_complete) * 100.0 / count(*), 6) AS complete_pct, count(*) FILTER (WHERE session = 'Race') AS races,
       count(*) FILTER (WHERE session = 'Race' AND is_complete) AS complete_races, count(*) FILTER (WHERE session = 'Qualifying') AS qualifying, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS years,
       round(avg(CASE WHEN is_complete THEN 3 ELSE 2 END / 7.0 * 100), 6) AS mean_score FROM (SELECT year AS y, * FROM cat) GROUP BY ROLLUP (year)"""
          .replace("min(year)", "min(y)").replace("max(year)", "max(y)").replace("count(DISTINCT year)", "count(DISTINCT y)"), "C14 C15 (summary, races by year)")
def q_catalog_summary(spark, sf_dir):
    return rounded(M.catalog_summary(_stored_catalog(spark, sf_dir)))


@register("catalog_report", f"WITH {_ROWS}" + """
SELECT year, session, count(*) AS total, count(*) FILTER (WHERE is_complete) AS complete, (SELECT round(avg(CASE WHEN c.is_complete THEN 3 ELSE 2 END / 7.0 * 100), 2)
       FROM cat c WHERE c.year = cat.year) AS mean_completeness FROM cat GROUP BY ALL""", "C22 (report tables: by year and session, mean by year)")
def q_catalog_report(spark, sf_dir):
    tables = M.report_tables(_stored_catalog(spark, sf_dir))
    return tables["by_year_session"].join(tables["mean_score_by_year"], "year")


@register("catalog_readback", f"WITH {_ROWS}" + """
SELECT s.sink, year, event AS event_name, session, is_complete, round(CASE WHEN laps THEN 3 ELSE 2 END / 7.0 * 100, 6) AS completeness_score
FROM cat, (VALUES ('csv'), ('parquet')) s(sink)""", "C13 (catalog read back from both sinks)")
def q_catalog_readback(spark, sf_dir):
    out = scratch_path(spark, "catalog-out")
    M.catalog_job(spark, _land(spark, sf_dir), first_year=None, glob="part-*", out=out)
    cols = ["year", "event_name", "session", "is_complete", "completeness_score"]
    parquet = spark.read.parquet(f"{out}/race_catalog.parquet").select(F.lit("parquet").alias("sink"), *cols)
    csv = spark.read.option("header", True).csv(f"{out}/race_catalog.csv")
    csv = csv.select(F.lit("csv").alias("sink"), *[F.col(c).cast(parquet.schema[c].dataType).alias(c) for c in cols])
    return rounded(parquet.unionByName(csv))


@register("results_skips", f"""WITH {_ROWS}
SELECT count(*) FILTER (WHERE reason IS NOT NULL)::BIGINT AS skipped, count(*)::BIGINT AS selected, count(*) FILTER (WHERE reason IS NULL)::BIGINT AS processed
FROM gate WHERE session = 'Race'""", "R13 L21 (accounting of the results job)")
def q_results_skips(spark, sf_dir):
    from lapdeck.operators.results import accounting, select_races
    cat = _stored_catalog(spark, sf_dir)
    job = M.race_results_job(spark, _land(spark, sf_dir), cat)
    return accounting(select_races(cat), job.skips).select("skipped", "selected", "processed")


@register("stream_catalog_state", f"""WITH {_ROWS}
SELECT year, event, session, TRUE AS has_results, session LIKE 'Practice%' AS has_session_info, FALSE AS has_laps, FALSE AS is_complete,
       round(CASE WHEN session LIKE 'Practice%' THEN 2 ELSE 1 END / 7.0 * 100, 6) AS completeness_score FROM n""", "T3 (catalog kept by streaming state)")
def q_stream_catalog_state(spark, sf_dir):
    """All orders land in three goes, by year; after each one the stream is started anew from its checkpoint.  The last go also brings
    the session_info of sessions landed before."""
    root, target, checkpoint = (scratch_path(spark, f"state-{x}") for x in ("landing", "target", "checkpoint"))
    results = _results(_orders(spark, sf_dir))
    info = results.filter(F.col("session").startswith("Practice")).groupBy(*KEYS).agg(F.count("*").alias("total_laps"))
    for k, years in enumerate((F.col("year") <= 1996, F.col("year").isin(1997, 1998), F.col("year") >= 1999)):
        write_objects(results.filter(years).select(*KEYS, "DriverNumber", "Position", "Status"), root, "results")
        if k == 2:
            write_objects(info, root, "session_info")
        start_catalog_state(spark, root, target, checkpoint).awaitTermination()
    out = spark.read.schema("year int, event string, session string, has_results boolean, has_session_info boolean, has_laps boolean, is_complete boolean, "
                            "completeness_score double").parquet(target)
    return rounded(out.select(*KEYS, "has_results", "has_session_info", "has_laps", "is_complete", "completeness_score"))
