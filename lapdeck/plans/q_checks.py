"""Dataset checks (K1, K2, K4, K5, K6) on lineitem and documents / labels."""

from __future__ import annotations

from lapdeck.operators import checks as K
from lapdeck.plans.registry import register, rounded, table

SQL_ROWCOUNT = """
SELECT 'lines_per_order' AS "check", 'warning' AS severity,
  CAST(count(*) AS DOUBLE) AS measured,
  printf('[%d, %d]', count(DISTINCT l_orderkey) * 1, count(DISTINCT l_orderkey) * 7) AS "limit",
  count(*) BETWEEN count(DISTINCT l_orderkey) * 1 AND count(DISTINCT l_orderkey) * 7 AS ok
FROM lineitem
"""


@register("check_rowcount", SQL_ROWCOUNT, "K1")
def q_rowcount(spark, sf_dir):
    return K.run_checks(table(spark, sf_dir, "lineitem"),
                        [K.rows_per_key("lines_per_order", "l_orderkey", 1, 7)])


SQL_DUPS = """
SELECT 'dup_order_line' AS "check", 'error' AS severity,
  CAST(COALESCE(sum(n), 0) AS DOUBLE) AS measured, '0' AS "limit", COALESCE(sum(n), 0) = 0 AS ok
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
"""


@register("check_dups", SQL_DUPS, "K2")
def q_dups(spark, sf_dir):
    return K.run_checks(table(spark, sf_dir, "lineitem"),
                        [K.duplicates("dup_order_line", ["l_orderkey", "l_linenumber"])])


SQL_NULLS = """
SELECT 'quality_null_share' AS "check", 'warning' AS severity,
  round(COALESCE(avg(CASE WHEN l.quality IS NULL THEN 1.0 ELSE 0.0 END), 0), 6) AS measured,
  '<= 0.5' AS "limit",
  COALESCE(avg(CASE WHEN l.quality IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.5 AS ok
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


@register("check_nulls", SQL_NULLS, "K4 (labels left-joined to documents)")
def q_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), ["doc_id"], "left")
    return rounded(K.run_checks(joined, [K.nulls("quality_null_share", "quality", 0.5)]))


SQL_RANGE = """
SELECT * FROM (
  SELECT 'quantity_range' AS "check", 'warning' AS severity,
    CAST(count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS DOUBLE) AS measured,
    '[1, 50]' AS "limit", count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) = 0 AS ok
  FROM lineitem
  UNION ALL
  SELECT 'discount_range', 'warning',
    CAST(count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05) AS DOUBLE),
    '[0, 0.05]', count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05) = 0
  FROM lineitem)
"""


@register("check_range", SQL_RANGE, "K5")
def q_range(spark, sf_dir):
    return K.run_checks(table(spark, sf_dir, "lineitem"),
                        [K.in_range("quantity_range", "l_quantity", 1, 50),
                         K.in_range("discount_range", "l_discount", 0, 0.05)])


SQL_ALL = """
SELECT * FROM (
  SELECT 'lines_per_order' AS "check", 'warning' AS severity, CAST(count(*) AS DOUBLE) AS measured,
    printf('[%d, %d]', count(DISTINCT l_orderkey) * 1, count(DISTINCT l_orderkey) * 7) AS "limit",
    count(*) BETWEEN count(DISTINCT l_orderkey) AND count(DISTINCT l_orderkey) * 7 AS ok
  FROM lineitem
  UNION ALL
  SELECT 'shipdate_nulls', 'warning',
    round(COALESCE(avg(CASE WHEN l_shipdate IS NULL THEN 1.0 ELSE 0.0 END), 0), 6), '<= 0.0',
    COALESCE(avg(CASE WHEN l_shipdate IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.0
  FROM lineitem
  UNION ALL
  SELECT 'tax_range', 'warning',
    CAST(count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.08) AS DOUBLE), '[0, 0.08]',
    count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.08) = 0
  FROM lineitem
  UNION ALL
  SELECT 'dup_order_line', 'error', CAST(COALESCE(sum(n), 0) AS DOUBLE), '0', COALESCE(sum(n), 0) = 0
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL
  SELECT 'required_columns', 'error', 1.0, 'missing: l_comment', FALSE)
"""


@register("check_all", SQL_ALL, "K6 (all checks, one table)")
def q_all(spark, sf_dir):
    checks = [K.rows_per_key("lines_per_order", "l_orderkey", 1, 7),
              K.nulls("shipdate_nulls", "l_shipdate", 0.0),
              K.in_range("tax_range", "l_tax", 0, 0.08),
              K.duplicates("dup_order_line", ["l_orderkey", "l_linenumber"]),
              K.required("required_columns", ["l_orderkey", "l_comment"])]
    return rounded(K.run_checks(table(spark, sf_dir, "lineitem"), checks))
