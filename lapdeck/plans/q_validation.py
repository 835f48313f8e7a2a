"""Row validation (V1, V3, V14, V15) and key normalisation (S6) on
customer / lineitem / documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.functions.columns import event_key, upper_in_domain
from lapdeck.operators import validation as v
from lapdeck.plans.registry import register, rounded, table

# Market segments of the customer table.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

CUSTOMER_RULES = [
    v.required("c_name"),
    v.in_range("c_acctbal", 0, None),
    v.in_range("c_nationkey", 0, 24),
    v.in_domain("c_mktsegment", SEGMENTS, severity="warning"),
]

LINEITEM_RULES = [
    v.in_range("l_quantity", 1, 50),
    v.in_range("l_discount", 0, 0.1),
    v.in_range("l_tax", 0, 0.08),
    v.in_domain("l_returnflag", ("A", "N", "R"), severity="error", optional=False),
    v.required("l_shipdate"),
]

DOCUMENT_RULES = [
    v.required("text"),
    v.custom("text shorter than 50 characters",
             lambda p: F.col("n_chars") >= 50, "warning"),
    v.in_domain("lang", ("en", "de", "fr"), severity="warning"),
    v.custom("n_chars differs from text length",
             lambda p: F.col("n_chars") == F.length("text"), "warning"),
]

_CUST_FAIL = """
  CASE WHEN c_name IS NULL THEN 'c_name is required: null' END,
  CASE WHEN NOT COALESCE(c_acctbal >= 0, FALSE)
       THEN 'c_acctbal in [0, None]: ' || COALESCE(CAST(c_acctbal AS VARCHAR), 'null') END,
  CASE WHEN NOT COALESCE(c_nationkey >= 0 AND c_nationkey <= 24, FALSE)
       THEN 'c_nationkey in [0, 24]: ' || COALESCE(CAST(c_nationkey AS VARCHAR), 'null') END
"""

SQL_SPLIT = f"""
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment
FROM customer
WHERE concat_ws('; ', {_CUST_FAIL}) = ''
"""


@register("validate_split", SQL_SPLIT, "V1 (valid side)")
def q_split(spark, sf_dir):
    valid, _ = v.split_valid(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return rounded(valid)


SQL_ERRORS = f"""
SELECT c_custkey, concat_ws('; ', {_CUST_FAIL}) AS errors
FROM customer
WHERE concat_ws('; ', {_CUST_FAIL}) <> ''
"""


@register("validate_errors", SQL_ERRORS, "V1 (invalid side, reasons)")
def q_errors(spark, sf_dir):
    _, invalid = v.split_valid(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return invalid.select("c_custkey", F.array_join("errors", "; ").alias("errors"))


SQL_FIRST_ERRORS = f"""
SELECT 'Row ' || CAST(c_custkey AS VARCHAR) || ': ' || concat_ws('; ', {_CUST_FAIL}) AS error
FROM customer
WHERE concat_ws('; ', {_CUST_FAIL}) <> ''
ORDER BY c_custkey LIMIT 10
"""


@register("validate_first_errors", SQL_FIRST_ERRORS, "V3 (first 10 errors)")
def q_first_errors(spark, sf_dir):
    vd = v.validate(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return v.first_errors(vd, ["c_custkey"], 10)


SQL_SUMMARY = """
WITH f AS (
  SELECT NOT (COALESCE(l_quantity >= 1 AND l_quantity <= 50, FALSE)
          AND COALESCE(l_discount >= 0 AND l_discount <= 0.1, FALSE)
          AND COALESCE(l_tax >= 0 AND l_tax <= 0.08, FALSE)
          AND COALESCE(l_returnflag IN ('A', 'N', 'R'), FALSE)
          AND l_shipdate IS NOT NULL) AS bad
  FROM lineitem
)
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS valid_rows,
  CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS invalid_rows,
  round(COALESCE(count(*) FILTER (WHERE NOT bad) * 100.0 / NULLIF(count(*), 0), 0), 6)
    AS validation_rate
FROM f
"""


@register("validate_summary", SQL_SUMMARY, "V3")
def q_summary(spark, sf_dir):
    return rounded(v.summary(v.validate(table(spark, sf_dir, "lineitem"), LINEITEM_RULES)))


SQL_WARNINGS = """
SELECT doc_id, concat_ws('; ',
  CASE WHEN NOT COALESCE(n_chars >= 50, FALSE) THEN 'text shorter than 50 characters' END,
  CASE WHEN NOT COALESCE(lang IS NULL OR lang IN ('en', 'de', 'fr'), FALSE)
       THEN 'lang in domain: ' || COALESCE(lang, 'null') END,
  CASE WHEN NOT COALESCE(n_chars = length(text), FALSE)
       THEN 'n_chars differs from text length' END) AS warnings,
  text IS NOT NULL AS is_valid
FROM documents
"""


@register("validate_warnings", SQL_WARNINGS, "V14")
def q_warnings(spark, sf_dir):
    vd = v.validate(table(spark, sf_dir, "documents"), DOCUMENT_RULES)
    return vd.select("doc_id", F.array_join("warnings", "; ").alias("warnings"),
                     (F.size("errors") == 0).alias("is_valid"))


SQL_NORMALISE = """
SELECT doc_id,
  replace(lower(source || ' ' || lang), ' ', '_') AS source_key,
  CASE WHEN upper(lang) IN ('EN', 'DE', 'FR') THEN upper(lang) ELSE lang END AS lang_code
FROM documents
"""


@register("normalise_text", SQL_NORMALISE, "V15 S6 (key rule)")
def q_normalise(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id",
                    event_key(F.concat_ws(" ", "source", "lang")).alias("source_key"),
                    upper_in_domain("lang", ("EN", "DE", "FR")).alias("lang_code"))


# Dimension of the event types (type, category, counts as ok).
EVENT_TYPE_DIM = [("click", "engagement", True), ("view", "engagement", True),
                  ("purchase", "conversion", True), ("signup", "conversion", True),
                  ("error", "failure", False)]

SQL_DOMAIN = """
SELECT e.event_id, e.event_type, d.category, d.is_ok
FROM events e LEFT JOIN (VALUES ('click', 'engagement', TRUE), ('view', 'engagement', TRUE),
  ('purchase', 'conversion', TRUE), ('signup', 'conversion', TRUE), ('error', 'failure', FALSE))
  AS d(event_type, category, is_ok) ON e.event_type = d.event_type
"""


@register("domain_lookup", SQL_DOMAIN, "V16 (broadcast join with a fixed dimension)")
def q_domain(spark, sf_dir):
    dim = spark.createDataFrame(EVENT_TYPE_DIM, "event_type string, category string, is_ok boolean")
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    # the dimension's size is fixed by this file, so broadcasting it is safe
    return ev.join(F.broadcast(dim), ["event_type"], "left").select(
        "event_id", "event_type", "category", "is_ok")


SQL_FAIL_REPORT = f"""
WITH bad AS (SELECT c_custkey, concat_ws('; ', {_CUST_FAIL}) AS why FROM customer WHERE concat_ws('; ', {_CUST_FAIL}) <> '')
SELECT 0 AS line, 'Validation failed with ' || count(*) || ' errors:' AS message FROM bad HAVING count(*) > 0
UNION ALL SELECT row_number() OVER (ORDER BY c_custkey)::INT, 'Row ' || c_custkey || ': ' || why FROM (SELECT * FROM bad ORDER BY c_custkey LIMIT 5)
"""


@register("validate_fail_report", SQL_FAIL_REPORT, "V2 (fail fast on rows that do fail: count and first five messages)")
def q_fail_report(spark, sf_dir):
    checked = v.validate(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    lines: list[str] = []
    try:
        v.fail_fast(checked, ["c_custkey"])
    except ValueError as e:  # the outcome that is reported: a count and five messages
        lines = str(e).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line int, message string")


_CODES = ("R", "Q", "S", "SS", "SQ", "FP1", "FP2", "FP3", "XX")
_STATUSES, _TYRES = ("Finished", "DNF", "Lapped", "Parked"), ("SOFT", "WET", "HYPERSOFT")
SQL_CODES = """
WITH t AS (SELECT list_extract(['R', 'Q', 'S', 'SS', 'SQ', 'FP1', 'FP2', 'FP3', 'XX'], (1 + o_orderkey % 9)::INT) AS code,
                  list_extract(['Finished', 'DNF', 'Lapped', 'Parked'], (1 + o_custkey % 4)::INT) AS status,
                  list_extract(['SOFT', 'WET', 'HYPERSOFT'], (1 + o_custkey % 3)::INT) AS compound FROM orders)
SELECT code, CASE code WHEN 'R' THEN 'Race' WHEN 'Q' THEN 'Qualifying' WHEN 'S' THEN 'Sprint' WHEN 'SS' THEN 'Sprint Shootout' WHEN 'SQ' THEN 'Sprint Qualifying'
       WHEN 'FP1' THEN 'Practice 1' WHEN 'FP2' THEN 'Practice 2' WHEN 'FP3' THEN 'Practice 3' END AS session_name,
       status, status <> 'Parked' AS status_known, compound, compound <> 'HYPERSOFT' AS compound_known, count(*) AS rows FROM t GROUP BY ALL
"""


@register("domain_codes", SQL_CODES, "V16 (session codes, driver statuses, compounds)")
def q_domain_codes(spark, sf_dir):
    from lapdeck.functions import domains as D

    def pick(values, key):
        return F.element_at(F.array(*[F.lit(x) for x in values]), (1 + F.col(key) % len(values)).cast("int"))

    rows = table(spark, sf_dir, "orders").select(pick(_CODES, "o_orderkey").alias("code"), pick(_STATUSES, "o_custkey").alias("status"),
                                                 pick(_TYRES, "o_custkey").alias("compound"))
    known = D.mark_known(D.label_session_codes(rows), {"status": D.DRIVER_STATUSES, "compound": D.COMPOUNDS})
    return known.groupBy("code", "session_name", "status", "status_known", "compound", "compound_known").agg(F.count("*").alias("rows"))
