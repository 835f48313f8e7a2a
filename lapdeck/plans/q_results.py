"""Results operators (R3, R4, R6-R9, R13) on orders / lineitem.

Roles: a race result row = an order; finish position = the digit of
``o_orderpriority`` (1..5); status = ``o_orderstatus`` with F and O counted
as finished; race time = ``o_totalprice`` (numeric passes through).  The
"qualifying" side = lineitem aggregated per order: grid = number of lines,
Q1 = sum of extended price, Q2 = max discount.  257 orders at sf0.01 have
no line, so the left-join NULL path runs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapdeck.operators.results import (ResultsSpec, accounting, attach_qualifying,
                                       first_per_key, outcome_features,
                                       skipped_races)
from lapdeck.plans.registry import register, rounded, table

ORDERS_SPEC = ResultsSpec(
    race_keys=(),
    driver="o_orderkey",
    finish="finish_position",
    grid="grid_position",
    status="o_orderstatus",
    finished_statuses=("F", "O"),
    top_n=2,
    quali_cols=("q1", "q2"),
    duration_cols=("q1", "q2", "race_time"),
)


def _orders_with_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.substring("o_orderpriority", 1, 1).try_cast("int").cast("double").alias("finish_position"),
        F.col("o_totalprice").alias("race_time"))
    per_order = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).cast("double").alias("grid_position"),
                      F.sum("l_extendedprice").alias("q1"),
                      F.max("l_discount").alias("q2"))
                 .withColumnRenamed("l_orderkey", "o_orderkey"))
    return attach_qualifying(orders, per_order, ORDERS_SPEC, keys=["o_orderkey"])


SQL_LEFT_JOIN = """
WITH o AS (
  SELECT o_orderkey, o_orderstatus,
         CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE) AS finish_position,
         o_totalprice AS race_time
  FROM orders
), l AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS grid_position,
         sum(l_extendedprice) AS q1, max(l_discount) AS q2
  FROM lineitem GROUP BY l_orderkey
)
SELECT o.o_orderkey, o.o_orderstatus,
  round(o.finish_position, 6) AS finish_position,
  round(o.race_time, 6) AS race_time,
  round(l.grid_position, 6) AS grid_position,
  round(l.q1, 6) AS q1, round(l.q2, 6) AS q2,
  round(l.grid_position - o.finish_position, 6) AS position_gain,
  COALESCE(o.finish_position <= 2, FALSE) AS finished_top10,
  COALESCE(o.o_orderstatus IN ('F', 'O'), FALSE) AS finished_race,
  NOT COALESCE(o.o_orderstatus IN ('F', 'O'), FALSE) AS dnf,
  round(l.q1, 6) AS q1_seconds, round(l.q2, 6) AS q2_seconds,
  round(o.race_time, 6) AS race_time_seconds
FROM o LEFT JOIN l ON o.o_orderkey = l.l_orderkey
"""


@register("results_left_join", SQL_LEFT_JOIN, "R4 R6 R7 R8 R9")
def q_left_join(spark, sf_dir):
    return rounded(outcome_features(_orders_with_lines(spark, sf_dir), ORDERS_SPEC))


_LI_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")

SQL_FIRST_MATCH = f"""
SELECT l_orderkey, {", ".join(c for c in _LI_ORDER)}
FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LI_ORDER)}) AS rn
  FROM lineitem
) WHERE rn = 1
"""


@register("results_first_match", SQL_FIRST_MATCH, "R3 (first match per key)")
def q_first_match(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return first_per_key(li, ["l_orderkey"], list(_LI_ORDER), cols=list(_LI_ORDER))


SQL_SKIPS = """
WITH sel AS (SELECT o_orderkey FROM orders),
prod AS (SELECT DISTINCT l_orderkey FROM lineitem),
sk AS (SELECT o_orderkey FROM sel WHERE o_orderkey NOT IN (SELECT l_orderkey FROM prod))
SELECT CAST((SELECT count(*) FROM sel) AS BIGINT) AS selected,
       CAST((SELECT count(*) FROM sk) AS BIGINT) AS skipped,
       CAST((SELECT count(*) FROM sel) - (SELECT count(*) FROM sk) AS BIGINT) AS processed,
       round(((SELECT count(*) FROM sel) - (SELECT count(*) FROM sk)) * 100.0
             / (SELECT count(*) FROM sel), 6) AS success_rate,
       round((SELECT count(*) FROM sk) * 100.0 / (SELECT count(*) FROM sel), 6) AS failure_rate
"""


@register("results_accounting", SQL_SKIPS, "R13 L21")
def q_accounting(spark, sf_dir):
    selected = table(spark, sf_dir, "orders").select("o_orderkey")
    produced = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    skips = skipped_races(selected, produced, ["o_orderkey"], "results missing")
    return rounded(accounting(selected, skips))


SQL_RESULT_CHECKS = """
WITH r AS (""" + SQL_LEFT_JOIN + """)
SELECT * FROM (
  SELECT 'rows_per_race' AS "check", 'warning' AS severity, CAST(count(*) AS DOUBLE) AS measured,
    printf('[%d, %d]', count(DISTINCT o_orderstatus) * 15, count(DISTINCT o_orderstatus) * 25)
      AS "limit",
    count(*) BETWEEN count(DISTINCT o_orderstatus) * 15 AND count(DISTINCT o_orderstatus) * 25 AS ok
  FROM r
  UNION ALL
  SELECT 'finish_position_nulls', 'warning',
    round(COALESCE(avg(CASE WHEN finish_position IS NULL THEN 1.0 ELSE 0.0 END), 0), 6), '<= 0.3',
    COALESCE(avg(CASE WHEN finish_position IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.3
  FROM r
  UNION ALL
  SELECT 'grid_position_nulls', 'warning',
    round(COALESCE(avg(CASE WHEN grid_position IS NULL THEN 1.0 ELSE 0.0 END), 0), 6), '<= 0.05',
    COALESCE(avg(CASE WHEN grid_position IS NULL THEN 1.0 ELSE 0.0 END), 0) <= 0.05
  FROM r
  UNION ALL
  SELECT 'finish_position_range', 'warning',
    CAST(count(*) FILTER (WHERE finish_position < 1 OR finish_position > 25) AS DOUBLE), '[1, 25]',
    count(*) FILTER (WHERE finish_position < 1 OR finish_position > 25) = 0
  FROM r
  UNION ALL
  SELECT 'duplicate_race_driver', 'error', CAST(COALESCE(sum(n), 0) AS DOUBLE), '0',
    COALESCE(sum(n), 0) = 0
  FROM (SELECT count(*) AS n FROM r GROUP BY o_orderstatus, o_orderkey HAVING count(*) > 1)
  UNION ALL
  SELECT 'required_columns', 'error', 2.0, 'missing: points,status', FALSE)
"""


@register("results_output_checks", SQL_RESULT_CHECKS, "R12 (output checks, race = order status)")
def q_result_checks(spark, sf_dir):
    from lapdeck.plans.motorsport import results_output_checks
    r = outcome_features(_orders_with_lines(spark, sf_dir), ORDERS_SPEC).select(
        F.col("o_orderstatus").alias("race_id"), F.col("o_orderkey").alias("driver_id"),
        F.col("o_orderkey").alias("driver_number"), "finish_position", "grid_position")
    return rounded(results_output_checks(r))
