"""Exact quantiles per group by rank selection over counted ranges.

``percentile`` keeps every distinct value of a group in one aggregate buffer, so a group with a third of all rows and
distinct values needs a third of them in one task.  Here no buffer grows with a group:

1. One aggregate counts each group's values.  A group of at most ``small_rows`` is sorted as it is.
2. In a larger one, the range that holds a wanted rank is cut into ``buckets`` equal parts; an aggregate with map-side
   combination counts the values of each part and keeps its least and greatest; the part with the rank is the next range, between
   these two.  Several ranks share the passes.  A range ends when it holds one value, or at most ``small_rows`` rows, which are sorted.
   A pass cuts ranges by the number of buckets, so there are about log(rows / small_rows) / log(buckets) of them.

Linear interpolation between ranks, as ``percentile`` and pandas do.  -inf, inf and NaN (the greatest) are counted apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapdeck.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys], F.lit(True))


def _prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__{k}" for k in keys})


def large_groups(df: DataFrame, keys: Sequence[str], value: Column, small_rows: int) -> DataFrame | None:
    """The keys of the groups with more than ``small_rows`` values, as a written table; None if there is no such group."""
    large = df.groupBy(*keys).agg(F.count(value).alias("__n")).filter(F.col("__n") > small_rows).select(*keys)
    large = _stored(large, "large-groups")
    return None if large.isEmpty() else large


def selected_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], small_rows: int = 1_000_000,
                       buckets: int = 1024) -> DataFrame:
    """(keys, q): the exact quantiles of every group's values, by rank selection whatever the group's size.

    NULL values don't count; a group without values has NULLs; equal values, one row and NULL keys are nothing special.
    """
    names = list(keys)
    keys = [f"key{i}" for i in range(len(names))]  # so that no name of the caller's meets one used here
    df = df.select(*[F.col(c).alias(k) for c, k in zip(names, keys, strict=True)], F.col(value).cast("double").alias("__x"))
    v = F.col("__x")
    inf = F.lit(float("inf"))
    finite = ~F.isnan(v) & (v > -inf) & (v < inf)
    facts = df.groupBy(*keys).agg(F.count(v).alias("n"), F.count_if(v == -inf).alias("low"), F.count_if(finite).alias("finite"), F.count_if(v == inf).alias("high"),
                                  F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"))
    facts = _stored(facts, "quantile-facts")
    # the ranks on either side of each quantile
    place = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: p * (F.col("n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(place, lambda x: F.array(F.floor(x), F.ceil(x)))))
    wanted = facts.filter("n > 0").withColumn("rank", F.explode(ranks))
    outside = (F.when(F.col("rank") < F.col("low"), -inf).when(F.col("rank") >= F.col("low") + F.col("finite") + F.col("high"), F.lit(float("nan")))
               .when(F.col("rank") >= F.col("low") + F.col("finite"), inf))
    known = F.coalesce(outside, F.when(F.col("lo") == F.col("hi"), F.col("lo")))
    # still: values of the range that are below the wanted one
    state = _stored(wanted.select(*keys, "rank", known.alias("answer"), (F.col("rank") - F.col("low")).alias("still"), "lo", "hi", F.col("finite").alias("size")), "quantile-ranks")
    done = state.filter("answer IS NOT NULL").select(*keys, "rank", "answer")
    rows = df.filter(finite).select(*keys, v.alias("__v"))
    todo = state.filter("answer IS NULL").drop("answer")
    while not todo.filter(F.col("size") > small_rows).isEmpty():
        ranges = _prefixed(todo.filter(F.col("size") > small_rows).select(*keys, "lo", "hi").distinct(), keys)
        inside = rows.join(ranges, _same(rows, ranges, keys) & F.col("__v").between(F.col("lo"), F.col("hi")))
        share = F.try_divide(F.col("__v") / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2)
        # no share: two neighbouring numbers near zero, whose difference is none
        part = F.when(share.isNotNull(), F.least(F.floor(share * buckets), F.lit(buckets - 1))).when(F.col("__v") > F.col("lo"), buckets - 1).otherwise(0)
        counted = inside.groupBy(*keys, "lo", "hi", part.alias("part")).agg(F.count("*").alias("k"), F.min("__v").alias("a"), F.max("__v").alias("z"))
        before = F.sum("k").over(Window.partitionBy(*keys, "lo", "hi").orderBy("part")) - F.col("k")  # at most ``buckets`` rows a range
        counted = _prefixed(_stored(counted.withColumn("before", before), "quantile-parts"), [*keys, "lo", "hi"])
        hot = todo.filter(F.col("size") > small_rows)
        on = _same(hot, counted, [*keys, "lo", "hi"]) & (F.col("still") >= F.col("before")) & (F.col("still") < F.col("before") + F.col("k"))
        step = hot.join(counted, on).select(*keys, "rank", (F.col("still") - F.col("before")).alias("still"), F.col("a").alias("lo"), F.col("z").alias("hi"), F.col("k").alias("size"))
        state = _stored(step.unionByName(todo.filter(F.col("size") <= small_rows)), "quantile-ranks")
        done = done.unionByName(state.filter("lo = hi").select(*keys, "rank", F.col("lo").alias("answer")))
        todo = state.filter("lo < hi")
    # ranges of at most small_rows rows: sorted
    ranges = _prefixed(todo.select(*keys, "lo", "hi").distinct(), keys)
    inside = rows.join(ranges, _same(rows, ranges, keys) & F.col("__v").between(F.col("lo"), F.col("hi")))
    at = F.row_number().over(Window.partitionBy(*keys, "lo", "hi").orderBy("__v")) - 1
    sorted_rows = _prefixed(inside.select(*keys, "lo", "hi", "__v", at.alias("at")), [*keys, "lo", "hi"])
    found = todo.join(sorted_rows, _same(todo, sorted_rows, [*keys, "lo", "hi"]) & (F.col("still") == F.col("at"))).select(*keys, "rank", F.col("__v").alias("answer"))
    answers = done.unionByName(found).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "answer"))).alias("by_rank"))
    answers = _prefixed(answers, keys)  # at most two ranks per quantile
    out = facts.join(answers, _same(facts, answers, keys), "left")

    def between(p: float) -> Column:
        x = F.lit(float(p)) * (F.col("n") - 1)
        a, b = F.element_at("by_rank", F.floor(x)), F.element_at("by_rank", F.ceil(x))
        return F.when(F.floor(x) == F.ceil(x), a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b)

    return out.select(*[F.col(k).alias(c) for c, k in zip(names, keys, strict=True)], F.when(F.col("n") > 0, F.array(*[between(p) for p in probs])).alias("q"))
