"""Planning operators.

Roles: a schedule row = an order (slots o_orderstatus, o_orderpriority) or a
part (event = p_name, slots p_brand, p_type); expected files per document =
the two label kinds, landed = non-null values in ``labels``; the run ledger
= ``conversations`` (event = conv_id, attempt = turn, success = assistant
turn).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.functions.columns import duration_seconds
from lapdeck.operators import planning as p
from lapdeck.plans.registry import register, rounded, table

SQL_UNPIVOT = """
SELECT o_orderkey, slot, session FROM (
  UNPIVOT (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)
  ON o_orderstatus, o_orderpriority INTO NAME slot VALUE session)
WHERE session IS NOT NULL AND session <> ''
"""


@register("plan_unpivot", SQL_UNPIVOT, "P3")
def q_unpivot(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return p.schedule_unpivot(o, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


SQL_SCOPE = """
SELECT p_name, s.session
FROM part, (VALUES ('Brand#1'), ('SMALL')) AS s(session)
WHERE p_name IS NOT NULL AND p_name <> '' AND NOT contains(p_name, 'Test')
"""


@register("plan_scope", SQL_SCOPE, "P2 P4 (all events x listed sessions)")
def q_scope(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return p.resolve_scope(part, None, ["Brand#1", "SMALL"], event_col="p_name",
                           slots=["p_brand", "p_type"])


SQL_SCOPE_EVENTS = """
SELECT e.p_name, u.session
FROM (VALUES ('small ring'), ('red widget'), ('no such part')) AS e(p_name)
JOIN (SELECT p_name, session FROM (
        UNPIVOT (SELECT p_name, p_brand, p_type FROM part)
        ON p_brand, p_type INTO NAME slot VALUE session)) u
  ON e.p_name = u.p_name
"""


@register("plan_scope_events", SQL_SCOPE_EVENTS, "P4 (listed events x their slots)")
def q_scope_events(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return p.resolve_scope(part, ["small ring", "red widget", "no such part"], None,
                           event_col="p_name", slots=["p_brand", "p_type"])


def _expected_landed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    expected = p.expected_files(docs, ["doc_id"], ["quality", "toxic"])
    labels = table(spark, sf_dir, "labels")
    landed = (labels.unpivot(["doc_id"], ["quality", "toxic"], "data_type", "value")
              .filter(F.col("value").isNotNull()).select("doc_id", "data_type"))
    return expected, landed


_LANDED = """
WITH expected AS (
  SELECT doc_id, t.data_type FROM documents, (VALUES ('quality'), ('toxic')) AS t(data_type)
), landed AS (
  SELECT DISTINCT doc_id, data_type FROM (
    UNPIVOT (SELECT doc_id, quality, toxic FROM labels)
    ON quality, toxic INTO NAME data_type VALUE value)
  WHERE value IS NOT NULL
)
"""

SQL_GAP = _LANDED + """
SELECT e.doc_id, e.data_type FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.doc_id = e.doc_id AND l.data_type = e.data_type)
"""


@register("plan_gap", SQL_GAP, "P6 (anti-join)")
def q_gap(spark, sf_dir):
    expected, landed = _expected_landed(spark, sf_dir)
    return p.gap_plan(expected, landed, ["doc_id"])


SQL_STATE = _LANDED + """,
f AS (
  SELECT e.doc_id, e.data_type, l.doc_id IS NOT NULL AS landed
  FROM expected e LEFT JOIN landed l ON e.doc_id = l.doc_id AND e.data_type = l.data_type
)
SELECT doc_id,
  COALESCE(array_to_string(list_sort(list(data_type) FILTER (WHERE landed)), ','), '') AS cached,
  COALESCE(array_to_string(list_sort(list(data_type) FILTER (WHERE NOT landed)), ','), '') AS missing,
  CAST(count(*) FILTER (WHERE landed) AS BIGINT) AS n_cached,
  CAST(count(*) AS BIGINT) AS n_expected,
  CASE WHEN count(*) FILTER (WHERE landed) = 0 THEN 'none'
       WHEN count(*) FILTER (WHERE landed) = count(*) THEN 'complete' ELSE 'partial' END AS state
FROM f GROUP BY doc_id
"""


@register("plan_state", SQL_STATE, "P6 P7 (session state)")
def q_state(spark, sf_dir):
    expected, landed = _expected_landed(spark, sf_dir)
    s = p.session_state(expected, landed, ["doc_id"])
    return s.select("doc_id", F.array_join("cached", ",").alias("cached"),
                    F.array_join("missing", ",").alias("missing"),
                    "n_cached", "n_expected", "state")


SQL_PRECEDENCE = """
WITH src AS (
  SELECT doc_id, quality, toxic, 1 AS source_rank FROM labels
  UNION ALL
  SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS quality, 0 AS toxic,
         2 AS source_rank FROM documents
  UNION ALL
  SELECT doc_id, CASE WHEN lang = 'en' THEN 1 END AS quality, 1 AS toxic,
         2 AS source_rank FROM documents
), ok AS (SELECT * FROM src WHERE quality IS NOT NULL),
win AS (SELECT doc_id, min(source_rank) AS source_rank FROM ok GROUP BY doc_id)
SELECT ok.doc_id, ok.quality, ok.toxic, ok.source_rank
FROM ok JOIN win ON ok.doc_id = win.doc_id AND ok.source_rank = win.source_rank
"""


@register("plan_precedence", SQL_PRECEDENCE, "P8 P9 (tiered sources)")
def q_precedence(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    heur = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("quality"),
        F.lit(0).alias("toxic"))
    # a second row per key in the same tier; both stay where that tier wins
    by_lang = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", 1).alias("quality"), F.lit(1).alias("toxic"))
    return p.resolve_precedence([(1, labels), (2, heur.unionByName(by_lang))], ["doc_id"],
                                valid=F.col("quality").isNotNull())


def _ledger(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("event"), F.col("turn").alias("attempt_ts"),
        (F.col("role") == "assistant").alias("success"))


SQL_LEDGER = """
SELECT CAST(count(*) AS BIGINT) AS attempts,
  CAST(count(*) FILTER (WHERE COALESCE(role = 'assistant', FALSE)) AS BIGINT) AS successes,
  CAST(count(*) FILTER (WHERE NOT COALESCE(role = 'assistant', FALSE)) AS BIGINT) AS failures,
  CAST(count(DISTINCT CASE WHEN role = 'assistant' THEN conv_id END) AS BIGINT) AS successful_events,
  round(COALESCE(count(*) FILTER (WHERE role = 'assistant') * 100.0 / NULLIF(count(*), 0), 0), 6)
    AS success_rate
FROM conversations
"""


@register("plan_ledger", SQL_LEDGER, "P14")
def q_ledger(spark, sf_dir):
    return rounded(p.ledger_summary(_ledger(spark, sf_dir)))


SQL_RETRY = """
SELECT DISTINCT c.conv_id AS event FROM conversations c
JOIN (SELECT conv_id, arg_max(role = 'assistant', turn) AS latest_success
      FROM conversations GROUP BY conv_id) l ON c.conv_id = l.conv_id
WHERE NOT l.latest_success
"""


@register("plan_retry", SQL_RETRY, "P16 (retry failed)")
def q_retry(spark, sf_dir):
    led = _ledger(spark, sf_dir)
    plan = led.select("event").distinct()
    return p.plan_remaining(plan, led, ["event"], "retry_failed")


SQL_SKIP = """
SELECT DISTINCT conv_id AS event FROM conversations
WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'assistant')
"""


@register("plan_skip_existing", SQL_SKIP, "P16 (skip existing)")
def q_skip(spark, sf_dir):
    led = _ledger(spark, sf_dir)
    plan = led.select("event").distinct()
    return p.plan_remaining(plan, led, ["event"], "skip_existing")


SQL_OVERVIEW = """
WITH u AS (
  SELECT user_id AS key, 'laps' AS t, event_type AS drv FROM events
  UNION ALL SELECT o_custkey, 'results', NULL FROM orders
)
SELECT key,
  COALESCE(bool_or(t = 'laps'), FALSE) AS has_laps,
  COALESCE(bool_or(t = 'results'), FALSE) AS has_results,
  FALSE AS has_weather, FALSE AS has_messages,
  CAST(count(*) FILTER (WHERE t = 'laps') AS BIGINT) AS lap_count,
  CAST(count(DISTINCT CASE WHEN t = 'laps' THEN drv END) AS BIGINT) AS driver_count
FROM u GROUP BY key
"""


@register("plan_overview", SQL_OVERVIEW, "P13")
def q_overview(spark, sf_dir):
    laps = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"),
                                                 F.col("event_type").alias("DriverNumber"))
    results = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    return p.session_overview({"laps": laps, "results": results}, ["key"])


SQL_STAMP = """
SELECT o.o_orderkey, o.o_custkey, c.c_name AS EventName, c.c_mktsegment AS SessionName
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""


@register("plan_stamp", SQL_STAMP, "P10")
def q_stamp(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return p.stamp_sessions(o, c, ["o_custkey"], {"c_name": "EventName",
                                                  "c_mktsegment": "SessionName"})


SQL_SECONDS = """
SELECT event_id, round(epoch(ts - date_trunc('day', ts)), 6) AS seconds_into_day
FROM events
"""


@register("seconds_from_duration", SQL_SECONDS, "P11")
def q_seconds(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    d = ev.select("event_id", (F.col("ts") - F.date_trunc("day", "ts")).alias("d"))
    dtype = d.schema["d"].dataType
    return rounded(d.select("event_id", duration_seconds("d", dtype).alias("seconds_into_day")))


SQL_ENABLED = """
SELECT o_orderkey, slot, session FROM (
  UNPIVOT (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)
  ON o_orderstatus, o_orderpriority INTO NAME slot VALUE session)
WHERE session IN ('F', '1-URGENT', '2-HIGH')
"""


@register("plan_enabled", SQL_ENABLED, "P5 (enabled-session filter)")
def q_enabled(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    u = p.schedule_unpivot(o, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])
    return p.filter_enabled(u, ["F", "1-URGENT", "2-HIGH"])


SQL_CACHE_SIZES = """
SELECT lang, source AS data_type, round(sum(n_chars) / 1048576.0, 9) AS mb
FROM documents GROUP BY lang, source
"""


@register("plan_cache_sizes", SQL_CACHE_SIZES, "P7 (size per table, as a map per session)")
def q_cache_sizes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        "lang", F.col("source").alias("data_type"), F.col("n_chars").alias("length"))
    sizes = p.cache_sizes(d, ["lang"])
    return sizes.select("lang", F.explode("size_mb").alias("data_type", "mb")).withColumn(
        "mb", F.round("mb", 9))


@register("ledger_append", """
SELECT CAST(conv_id AS VARCHAR) AS event, count(*) AS attempts, count(*) FILTER (WHERE role = 'assistant') AS successes,
       arg_max(role = 'assistant', turn) AS latest_success
FROM conversations GROUP BY conv_id
""", "P14 (append-only ledger, written in two runs)")
def q_ledger_append(spark, sf_dir):
    from lapdeck.session import scratch_path
    from lapdeck.sources.sinks import append_ledger
    c = table(spark, sf_dir, "conversations").select(
        F.lit(2024).alias("year"), F.col("conv_id").cast("string").alias("event"), F.timestamp_seconds("turn").alias("attempt_ts"),
        (F.col("role") == "assistant").alias("success"), "turn")
    path = scratch_path(spark, "ledger")
    append_ledger(c.filter("turn % 2 = 0"), path)
    ledger = append_ledger(c.filter("turn % 2 <> 0"), path)
    return ledger.groupBy("event").agg(
        F.count("*").alias("attempts"), F.count_if("success").alias("successes"), F.max_by("success", "attempt_ts").alias("latest_success"))


@register("plan_season_tag", "SELECT o_orderkey, year(o_orderdate)::INT AS Season FROM orders", "P1")
def q_season_tag(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return p.season_tag(o.select("o_orderkey", "o_orderdate"), F.year("o_orderdate")).select("o_orderkey", "Season")


SQL_INFO = """
SELECT c_name AS event_name, lower(c_name) AS location, CAST(c_nationkey AS VARCHAR) AS country, s.name AS session_name,
       TIMESTAMP '2024-03-01 10:00:00' + to_days(CAST(c_custkey % 300 + s.i AS INTEGER)) AS session_date,
       c_mktsegment AS event_format, CAST(c_custkey AS INT) AS round_number, 'Grand ' || c_name AS official_event_name,
       'Practice 1' AS session_1, CASE WHEN c_custkey % 4 = 0 THEN 'Sprint' END AS session_2, 'Race' AS session_3
FROM customer, (VALUES (0, 'Practice 1'), (1, 'Sprint'), (2, 'Race')) s(i, name)
WHERE s.name <> 'Sprint' OR c_custkey % 4 = 0
"""


@register("session_info_build", SQL_INFO, "P12")
def q_session_info(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    day = [F.expr(f"timestamp_ntz'2024-03-01 10:00:00' + make_dt_interval(cast(c_custkey % 300 + {i} as int))") for i in range(3)]
    schedule = c.select(
        F.col("c_name").alias("EventName"), F.lower("c_name").alias("Location"), F.col("c_nationkey").cast("string").alias("Country"),
        F.col("c_mktsegment").alias("EventFormat"), F.col("c_custkey").cast("int").alias("RoundNumber"),
        F.concat(F.lit("Grand "), "c_name").alias("OfficialEventName"), F.lit("Practice 1").alias("Session1"),
        F.when(F.col("c_custkey") % 4 == 0, "Sprint").alias("Session2"), F.lit("Race").alias("Session3"),
        F.lit(None).cast("string").alias("Session4"), F.lit(None).cast("string").alias("Session5"),
        *[d.alias(f"Session{i}DateUtc") for i, d in enumerate(day, 1)],
        *[F.lit(None).cast("timestamp_ntz").alias(f"Session{i}DateUtc") for i in (4, 5)])
    plan = p.schedule_unpivot(schedule, ["EventName"]).select("EventName", "session")
    info = p.session_info_rows(schedule, plan)
    return info.select("event_name", "location", "country", "session_name", "session_date", "event_format", "round_number",
                       "official_event_name", "session_1", "session_2", "session_3")
