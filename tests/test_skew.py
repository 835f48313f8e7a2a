"""Hot keys: a key holding a third of all rows must not land in one task.

Join-back operators (C16, C20, P8) salt every key.  Broadcast joins are switched off so the
salted shuffle join is what runs.
"""

import pytest
from pyspark.sql import functions as F

from lapdeck.functions.joins import join_back
from lapdeck.operators.catalog import flag_duplicates, flag_missing_partner

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(spark, n=60000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("ts"),
        F.when(F.col("id") % 7 == 0, F.lit("view")).otherwise(F.lit("purchase")).alias("kind"))


def test_join_back_spreads_a_hot_key(spark, no_broadcast):
    rows = _hot(spark)
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("mx"))
    plain = rows.join(facts, "k", "left")
    salted = join_back(rows, facts, ["k"], salts=16)
    tasks = lambda df: df.filter("k = 0").select(F.spark_partition_id()).distinct().count()
    assert tasks(salted) >= 6          # the hot key is processed by several tasks
    a = sorted(map(tuple, plain.select("k", "ts", "n", "mx").collect()))
    b = sorted(map(tuple, salted.select("k", "ts", "n", "mx").collect()))
    assert a == b                      # same rows, same facts


def test_equal_rows_are_spread(spark, no_broadcast):
    rows = spark.range(20000).select(F.lit(1).alias("k"), F.lit("same").alias("v")).union(
        spark.range(1000).select(F.col("id").cast("int") + 2, F.lit("x")))
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_back(rows, facts, ["k"], salts=16)
    tasks = out.filter("k = 1").groupBy(F.spark_partition_id().alias("p")).count()
    assert tasks.count() >= 6 and tasks.agg(F.max("count")).first()[0] < 10000
    assert out.count() == 21000 and out.filter("k = 1 and n <> 20000").isEmpty()


def test_duplicate_flag_with_hot_key(spark, no_broadcast):
    out = flag_duplicates(_hot(spark), ["k"])
    assert out.count() == 60000
    assert out.filter(~F.col("validation_passed")).count() == 60000  # every key repeats


def test_missing_partner_with_hot_key(spark, no_broadcast):
    df = _hot(spark).withColumn("k", F.when(F.col("k") == 0, 0).otherwise(F.col("ts") + 1))
    out = flag_missing_partner(df, ["k"], "kind", "purchase", "view", ["ts"], "M; ")
    flagged = out.filter(F.col("validation_warnings") != "")
    # key 0 has views; every other key is a single row: flagged iff it is a purchase
    assert flagged.filter(F.col("k") == 0).count() == 0
    assert flagged.count() == df.filter((F.col("k") != 0) & (F.col("kind") == "purchase")).count()


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    got = sorted((r.v, r.validation_passed) for r in flag_duplicates(df, ["k"]).collect())
    assert got == [(1, False), (2, False), (3, True)]


def test_join_back_with_map_column(spark, no_broadcast):
    rows = _hot(spark, 3000).withColumn("m", F.create_map(F.lit("a"), F.col("ts")))
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_back(rows, facts, ["k"], salts=4)
    assert out.count() == 3000 and out.filter(F.col("n").isNull()).count() == 0


def _arrives_in_any_order(spark):
    """Rows of a shuffle whose order within a partition is another one each time they are computed."""
    import random

    def deal(batches):
        rng = random.SystemRandom()
        for b in batches:
            at = list(range(b.num_rows))
            rng.shuffle(at)
            yield b.take(at)

    df = spark.range(4000).select((F.col("id") % 500).alias("k"), F.col("id").alias("ts")).repartition(4, "k")
    return df.mapInArrow(deal, df.schema)


def test_join_back_numbers_shuffled_rows_once(spark, no_broadcast):
    rows = _arrives_in_any_order(spark)
    facts = rows.groupBy("k").agg(F.max("ts").alias("n"))
    out = join_back(rows, facts, ["k"])
    assert out.count() == 4000 and out.filter(F.col("n").isNull()).count() == 0
    winners = facts.select("k")
    assert join_back(rows, winners, ["k"], "left_semi").count() == 4000
