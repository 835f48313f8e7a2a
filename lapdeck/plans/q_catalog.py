"""Catalog operators (C3-C22, S8) on events / orders / customer / lineitem /
documents.

Roles: a catalog entry = (user_id, day) of ``events``; its "files" are the
five event types; critical types (is_complete) = click, view, purchase.
C6/C7 attach per-customer order facts to ``customer``; C9-C11 treat each
order as an entry with year = year(o_orderdate), round = month.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.operators.catalog import (add_days_since_start, add_race_id,
                                       add_season_progress, attach_first, breakdown,
                                       completeness, first_n, flag_duplicates,
                                       flag_missing_partner, flag_missing_parts,
                                       freshness, overflow_count, presence_flags,
                                       quality_metrics, rollup_summary, verdict)
from lapdeck.plans.registry import register, rounded, table

# Event types of the driver's events table and the critical ones.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CRITICAL = ("click", "view", "purchase")


def presence(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return presence_flags(ev, ["user_id", "day"], "event_type", EVENT_TYPES)


_PRESENCE = """
WITH p AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
    COALESCE(bool_or(event_type = 'click'), FALSE) AS has_click,
    COALESCE(bool_or(event_type = 'error'), FALSE) AS has_error,
    COALESCE(bool_or(event_type = 'purchase'), FALSE) AS has_purchase,
    COALESCE(bool_or(event_type = 'signup'), FALSE) AS has_signup,
    COALESCE(bool_or(event_type = 'view'), FALSE) AS has_view
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)
"""

SQL_PRESENCE = _PRESENCE + """
SELECT *, CAST(has_click::INT + has_error::INT + has_purchase::INT + has_signup::INT
               + has_view::INT AS INTEGER) AS n_present
FROM p
"""


@register("catalog_presence", SQL_PRESENCE, "C3")
def q_presence(spark, sf_dir):
    return presence(spark, sf_dir)


SQL_SCORE = _PRESENCE + """
SELECT user_id, day, (has_click AND has_view AND has_purchase) AS is_complete,
  round((has_click::INT + has_error::INT + has_purchase::INT + has_signup::INT
         + has_view::INT) / 5 * 100.0, 6) AS completeness_score
FROM p
"""


@register("catalog_score", SQL_SCORE, "C4 C5")
def q_score(spark, sf_dir):
    c = completeness(presence(spark, sf_dir), EVENT_TYPES, CRITICAL)
    return rounded(c.select("user_id", "day", "is_complete", "completeness_score"))


SQL_ATTACH = """
SELECT c.c_custkey, c.c_name, f.o_orderdate AS first_order_date,
       f.o_orderstatus AS first_order_status, round(f.o_totalprice, 6) AS first_order_price
FROM customer c LEFT JOIN (
  SELECT * FROM (
    SELECT o_custkey, o_orderdate, o_orderstatus, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) WHERE rn = 1
) f ON c.c_custkey = f.o_custkey
"""


@register("catalog_metadata_attach", SQL_ATTACH, "C6")
def q_attach(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    out = attach_first(cust, orders, ["c_custkey"], ["o_orderdate", "o_orderkey"],
                       {"o_orderdate": "first_order_date",
                        "o_orderstatus": "first_order_status",
                        "o_totalprice": "first_order_price"})
    return rounded(out)


SQL_QUALITY = """
SELECT c.c_custkey, c.c_name, m.num_orders,
       COALESCE(m.has_null_totalprice, FALSE) AS has_null_totalprice,
       COALESCE(m.has_null_comment, FALSE) AS has_null_comment
FROM customer c LEFT JOIN (
  SELECT o_custkey, CAST(count(*) AS BIGINT) AS num_orders,
         bool_or(o_totalprice IS NULL) AS has_null_totalprice,
         FALSE AS has_null_comment
  FROM orders GROUP BY o_custkey
) m ON c.c_custkey = m.o_custkey
"""


@register("catalog_quality", SQL_QUALITY, "C7")
def q_quality(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    # o_comment is not a column of orders: its flag is False (absent column)
    return quality_metrics(cust, orders, ["c_custkey"],
                           {"o_totalprice": "has_null_totalprice",
                            "o_comment": "has_null_comment"}, count_name="num_orders")


def _order_entries(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"))


SQL_RACE_ID = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS round,
       printf('%d_R%02d', year(o_orderdate), month(o_orderdate)) AS race_id
FROM orders
"""


@register("catalog_race_id", SQL_RACE_ID, "C9")
def q_race_id(spark, sf_dir):
    return add_race_id(_order_entries(spark, sf_dir)).drop("o_orderdate")


SQL_DAYS = """
SELECT o_orderkey,
  CAST(date_sub('day', (SELECT min(o_orderdate) FROM orders), o_orderdate) AS BIGINT)
    AS days_since_start
FROM orders
"""


@register("catalog_days", SQL_DAYS, "C10")
def q_days(spark, sf_dir):
    e = add_days_since_start(_order_entries(spark, sf_dir), "o_orderdate")
    return e.select("o_orderkey", "days_since_start")


SQL_PROGRESS = """
WITH e AS (SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS round FROM orders),
mm AS (SELECT year, min(round) AS lo, max(round) AS hi FROM e GROUP BY year)
SELECT e.o_orderkey, CAST(e.year AS INTEGER) AS year, CAST(e.round AS INTEGER) AS round,
  round(CASE WHEN mm.hi = mm.lo THEN 0.0 ELSE (e.round - mm.lo) / (mm.hi - mm.lo) END, 6)
    AS season_progress
FROM e JOIN mm ON e.year = mm.year
"""


@register("catalog_progress", SQL_PROGRESS, "C11")
def q_progress(spark, sf_dir):
    e = add_season_progress(_order_entries(spark, sf_dir))
    return rounded(e.select("o_orderkey", "year", "round", "season_progress"))


SQL_MISSING_PARTNER = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
g AS (SELECT user_id, day, bool_or(event_type = 'view') AS has_view FROM ev GROUP BY user_id, day),
firstp AS (
  SELECT user_id, day, event_id FROM (
    SELECT user_id, day, event_id,
           row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rn
    FROM ev WHERE event_type = 'purchase') WHERE rn = 1
)
SELECT f.user_id, f.day, f.event_id, 'Missing view event; ' AS validation_warnings
FROM firstp f JOIN g ON f.user_id = g.user_id AND f.day = g.day
WHERE NOT g.has_view
"""


@register("catalog_missing_partner", SQL_MISSING_PARTNER, "C16")
def q_missing_partner(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    flagged = flag_missing_partner(ev, ["user_id", "day"], "event_type", "purchase",
                                   "view", ["ts", "event_id"], "Missing view event; ")
    return (flagged.filter(F.col("validation_warnings") != "")
            .select("user_id", "day", "event_id", "validation_warnings"))


SQL_MISSING_PARTS = _PRESENCE + """
SELECT user_id, day,
  CASE WHEN has_click AND has_view AND has_purchase THEN ''
       ELSE 'Missing files: ' || concat_ws(', ',
              CASE WHEN NOT has_click THEN 'click' END,
              CASE WHEN NOT has_view THEN 'view' END,
              CASE WHEN NOT has_purchase THEN 'purchase' END) || '; ' END
    AS validation_warnings
FROM p
"""


@register("catalog_missing_parts", SQL_MISSING_PARTS, "C17")
def q_missing_parts(spark, sf_dir):
    p = flag_missing_parts(presence(spark, sf_dir), [(t, f"has_{t}") for t in CRITICAL])
    return p.select("user_id", "day", "validation_warnings")


SQL_DUPS = """
WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  (d.l_orderkey IS NULL) AS validation_passed,
  CASE WHEN d.l_orderkey IS NULL THEN '' ELSE 'Duplicate entry; ' END AS validation_errors
FROM lineitem l LEFT JOIN d ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
"""


@register("catalog_dups", SQL_DUPS, "C20")
def q_dups(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 "l_partkey", "l_suppkey")
    return flag_duplicates(li, ["l_orderkey", "l_linenumber"])


SQL_ROLLUP = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  GROUPING(year(o_orderdate)) = 1 AS is_total,
  CAST(count(*) AS BIGINT) AS entries,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS complete,
  CAST(count(*) FILTER (WHERE NOT (o_orderstatus = 'F')) AS BIGINT) AS incomplete,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*), 6) AS complete_pct,
  round(avg(o_totalprice), 6) AS mean_score
FROM orders GROUP BY ROLLUP (year(o_orderdate))
"""


@register("catalog_rollup", SQL_ROLLUP, "C14")
def q_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return rounded(rollup_summary(o, "year", F.col("o_orderstatus") == "F",
                                  F.col("o_totalprice")))


SQL_BREAKDOWN = """
SELECT lang, source, CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE n_chars >= 1000) AS BIGINT) AS complete
FROM documents GROUP BY lang, source
"""


@register("catalog_breakdown", SQL_BREAKDOWN, "C22")
def q_breakdown(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return breakdown(d, ["lang", "source"], F.col("n_chars") >= 1000)


SQL_INGEST_SUMMARY = """
SELECT source AS data_type, lang AS year_part,
  CASE WHEN GROUPING(source) = 0 THEN 'data_type'
       WHEN GROUPING(lang) = 0 THEN 'year' ELSE 'total' END AS level,
  CAST(count(*) AS BIGINT) AS objects,
  round(sum(n_chars) / 1048576.0, 6) AS size_mb
FROM documents GROUP BY GROUPING SETS ((source), (lang), ())
"""


@register("ingest_summary", SQL_INGEST_SUMMARY, "S8")
def q_ingest_summary(spark, sf_dir):
    from lapdeck.sources.manifest import ingest_summary
    d = table(spark, sf_dir, "documents").select(
        F.col("source").alias("data_type"), F.col("lang").alias("year_part"),
        F.col("n_chars").alias("length"))
    return rounded(ingest_summary(d))


SQL_TOP20 = _PRESENCE + """,
inc AS (SELECT user_id, day FROM p WHERE NOT (has_click AND has_view AND has_purchase))
SELECT user_id, day, CAST(GREATEST((SELECT count(*) FROM inc) - 20, 0) AS BIGINT) AS overflow
FROM inc ORDER BY user_id, day LIMIT 20
"""


@register("catalog_top20", SQL_TOP20, "C15 C22 (first 20 incomplete + overflow)")
def q_top20(spark, sf_dir):
    c = completeness(presence(spark, sf_dir), EVENT_TYPES, CRITICAL)
    inc = c.filter(~F.col("is_complete")).select("user_id", "day")
    return first_n(inc, 20, ["user_id", "day"]).withColumn(
        "overflow", overflow_count(inc, 20).cast("bigint"))


SQL_TOP_PER_GROUP = """
SELECT lang, doc_id, n_chars FROM (
  SELECT lang, doc_id, n_chars,
         row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn
  FROM documents) WHERE rn <= 3
"""


@register("catalog_top_per_group", SQL_TOP_PER_GROUP, "C22 (top-n per key)")
def q_top_per_group(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return first_n(d, 3, [F.col("n_chars").desc(), F.col("doc_id")], ["lang"])


SQL_FRESHNESS = """
SELECT max(ts) AS latest_date,
  CAST(date_sub('day', max(ts), TIMESTAMP '2024-03-01 00:00:00') AS BIGINT) AS age_days,
  COALESCE(date_sub('day', max(ts), TIMESTAMP '2024-03-01 00:00:00') > 21, FALSE) AS is_stale
FROM events WHERE event_type = 'purchase'
"""


@register("catalog_freshness", SQL_FRESHNESS, "C19")
def q_freshness(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return freshness(ev, "ts", "2024-03-01 00:00:00", F.col("event_type") == "purchase")


SQL_VERDICT = _PRESENCE + """,
ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
partner AS (SELECT user_id, day FROM ev GROUP BY user_id, day
            HAVING bool_or(event_type = 'purchase') AND NOT bool_or(event_type = 'view')),
k AS (
  SELECT (SELECT count(*) FROM p) AS n,
    (SELECT count(*) > 0 FROM partner)::INT
    + (SELECT count(*) FILTER (WHERE NOT (has_click AND has_view AND has_purchase)) > 0 FROM p)::INT
    + (SELECT COALESCE(date_sub('day', max(ts), TIMESTAMP '2024-03-01 00:00:00') > 21, FALSE)
       FROM events WHERE event_type = 'purchase')::INT AS warnings,
    (SELECT count(*) > 0 FROM (SELECT user_id FROM p GROUP BY user_id
                               HAVING count(*) > 1))::INT AS errors
)
SELECT errors = 0 AS validation_passed, CAST(errors AS BIGINT) AS total_errors,
  CAST(warnings AS BIGINT) AS total_warnings,
  round(100 * (1 - (errors * 0.5 + warnings * 0.1) / greatest(n, 1)), 2) AS data_quality_score
FROM k
"""


@register("catalog_verdict", SQL_VERDICT, "C21")
def q_verdict(spark, sf_dir):
    """One pass: the presence catalog with its duplicate flags (here: users with several entries), and one aggregate with
    an expression per check kind."""
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    latest = F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("purchase_ts")
    cat = presence_flags(ev, ["user_id", "day"], "event_type", EVENT_TYPES, extra=[latest])
    cat = flag_duplicates(completeness(cat, EVENT_TYPES, CRITICAL), ["user_id"])

    def any_row(cond):
        return F.coalesce(F.bool_or(cond), F.lit(False)).cast("int")

    stale = F.timestamp_diff("DAY", F.max("purchase_ts"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")) > 21
    facts = cat.agg(F.count(F.lit(1)).alias("n"), any_row(~F.col("validation_passed")).alias("errors"),
                    any_row(F.col("has_purchase") & ~F.col("has_view")).alias("partner"),
                    any_row(~F.col("is_complete")).alias("parts"), F.coalesce(stale, F.lit(False)).cast("int").alias("stale"))
    return facts.select(*verdict(F.col("n"), F.col("errors"), F.col("partner") + F.col("parts") + F.col("stale")))
