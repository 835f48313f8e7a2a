"""Rank selection against ``percentile``, and what bounds it."""

import math
import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lapdeck.operators.quantiles import selected_quantiles
from lapdeck.operators.sequences import SequenceSpec, sequence_features

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(1)
    rows = [("hot", rng.lognormvariate(0, 3) * rng.choice((1, -1))) for _ in range(4000)]  # a third of all rows, all distinct
    rows += [("ties", float(rng.randrange(5))) for _ in range(1500)] + [("equal", 7.25)] * 900 + [("one", 3.5), ("none", None), (None, 1.0), (None, 2.0)]
    rows += [("odd", x) for x in [math.inf, -math.inf, math.nan, math.nan] + [rng.gauss(0, 1e-300) for _ in range(300)]]
    rows += [("ends", x) for x in [1.7e308, -1.7e308, 5e-324, 0.0, -0.0] * 60] + [("nulls", None)] * 3 + [("nulls", 2.0)] * 2
    rows += [(f"g{i % 40}", rng.random()) for i in range(3000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(6)


@pytest.mark.parametrize("small,buckets", [(1_000_000, 1024), (50, 16)])
def test_equals_percentile(spark, values, small, buckets):
    got = {r.k: r.q for r in selected_quantiles(values, ["k"], "v", PROBS, small, buckets).collect()}
    want = {r.k: r.q for r in values.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, PROBS))).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k, q in want.items():
        assert (q is None) == (got[k] is None), k
        for a, b in zip(q or [], got[k] or [], strict=True):
            assert a == b or a != a and b != b or math.isclose(a, b, rel_tol=1e-12), (k, q, got[k])


def test_no_buffer_grows_with_a_group(spark, values):
    out = selected_quantiles(values, ["k"], "v", [0.5], small_rows=50, buckets=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # every buffer is a number, but for a group's few (rank, answer) pairs
    kept = set(re.findall(r"(?<=[ \[])(?:partial_)?(percentile|collect_list|collect_set|histogram_numeric)\(([a-z_]+)", plan))
    assert {f for f, _ in kept} <= {"collect_list"} and len(kept) <= 1


def test_features_are_the_same_by_either_way(spark):
    rng = random.Random(3)
    rows = [("r", "1" if i % 3 else str(i % 20), float(i), 60 + 100 * rng.random()) for i in range(2000)] + [(None, None, float(i), 70.0 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "race_id string, DriverNumber string, LapNumber double, LapTimeSeconds double").withColumn("Time", F.col("LapNumber"))
    spec = SequenceSpec(status=None, deleted=None, identity=None, team=None, stint=None, position=None, sectors=(None, None, None))
    key = lambda r: (str(r.race_id), str(r.DriverNumber))
    cols = ["race_id", "DriverNumber", "median_lap_time", "pct_05_lap_time", "pct_95_lap_time", "lap_time_iqr"]
    one, two = (sorted((r for r in sequence_features(df, s, ("counts", "pace", "consistency")).select(*cols).collect()), key=key) for s in (spec, replace(spec, quantile_rows=100)))
    assert len(one) == len(two) > 10
    for a, b in zip(one, two, strict=True):
        assert a[:2] == b[:2] and all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a[2:], b[2:], strict=True))


def test_empty(spark):
    assert selected_quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", [0.5]).collect() == []
