"""Mix sources to target weights by weighted fair queueing.

Each document of a source, in a shuffled order, finishes at the virtual time
``words of its source up to and including it / target of its source``.  Reading all documents by
virtual finish time serves every source in proportion to its target; the mix is cut where the
words read reach the total budget.  A source whose target exceeds its words is read again, up to
``max_epochs`` times.

Scale: the texts are read once for their sizes.  Running sums come from fixed buckets of the
shuffle order and of the finish time: sums per bucket (partial aggregates), a window over the
bucket sums, and a window inside each bucket, so a source with a third of all rows is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm.common import materialise, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHUFFLE_BITS = 24


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Sources by code point, null last, take ``weights`` in turn.  The budget (``share`` of all
    words) is split by weight; a target stops at ``max_epochs`` times its source's size and the
    excess goes to the others by weight until none is above.  That is the level L at which the sum of
    min(cap, L * weight) is the budget: with sources in order of cap / weight, the first k
    are capped for the smallest k whose level does not exceed the next ratio.  The windows run over one row
    per source, never over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.alias("weight")).withColumn("cap", F.col("source_size") * float(max_epochs))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", F.try_divide(left, weight_left)).withColumn("open", F.col("level") <= F.col("ratio"))
    level = F.min(F.when(F.col("open"), F.struct("ratio", "source", "level"))).over(everything)["level"]
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def _ordinal(col: Column, buckets: int) -> Column:
    """Bucket of a 64-bit hash, in the hash's order."""
    top = F.shiftright(col, 64 - SHUFFLE_BITS) + F.lit(1 << (SHUFFLE_BITS - 1))
    return F.shiftright(top * F.lit(buckets), SHUFFLE_BITS).cast("int")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = 3, seed: int = 17,
             rows_per_bucket: int = 1_000) -> DataFrame:
    """One row per document: the id, source, size, source_size, target, first_finish and copies.

    ``copies`` is how often the mix reads the document (0 to ``max_epochs``).  Null or wordless
    texts have size 0 and are never read.  A null source is a source of its own.  Documents are
    shuffled by a seeded hash of their id; equal finish times are taken or left together, so
    reruns and retried tasks agree; repeated rows count each.  An empty table gives no rows.
    """
    sized = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    word_count(F.col(text_col)).alias("size")), "mix-sizes")
    rows = sized.count()
    buckets = max(1, -(-rows // rows_per_bucket))
    at = F.xxhash64(F.lit(seed), F.col("id"))
    sized = sized.withColumn("at", at).withColumn("bucket", _ordinal(F.col("at"), buckets))

    cells = sized.groupBy("source", "bucket").agg(F.sum("size").alias("cell"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell").alias("source_size")), weights, share, max_epochs)
    t = targets.withColumnRenamed("source", "t_source")
    prior = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("prior", F.coalesce(F.sum("cell").over(prior), F.lit(0)))
    cells = cells.join(t, cells["source"].eqNullSafe(t["t_source"])).drop("t_source", "cell")
    c = cells.select(F.col("source").alias("c_source"), F.col("bucket").alias("c_bucket"), "prior", "source_size", "target")
    inner = Window.partitionBy("source", "bucket").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    queued = sized.withColumn("inner", F.sum("size").over(inner))
    queued = queued.join(c, queued["source"].eqNullSafe(c["c_source"]) & (queued["bucket"] == c["c_bucket"])).drop("c_source", "c_bucket")
    first = F.when((F.col("target") > 0) & (F.col("size") > 0), (F.col("prior") + F.col("inner")) / F.col("target"))
    queued = materialise(queued.select("id", "source", "size", "source_size", "target", first.alias("first_finish"),
                                       F.try_divide("source_size", "target").alias("lap")), "mix-queue")

    cut = _cut(queued, share, max_epochs, rows, rows_per_bucket)
    read = [F.coalesce((F.col("first_finish") + e * F.col("lap") <= F.lit(cut)).cast("int"), F.lit(0)) for e in range(max_epochs)]
    return queued.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                         "first_finish", sum(read, F.lit(0)).alias("copies"))


def _cut(queued: DataFrame, share: float, max_epochs: int, rows: int, rows_per_bucket: int) -> float:
    """The last virtual finish time within the budget.

    Finish times go into ranges of equal width; the budget ends inside one range, whose copies
    alone are sorted.  All sources finish their targets at time 1, so ranges up to 2 are enough.
    """
    budget = queued.agg(F.sum("size")).first()[0]
    if not budget:
        return -1.0
    width = 2.0 / max(64, 2 * -(-rows // rows_per_bucket))
    epochs = F.explode(F.array(*map(F.lit, range(max_epochs))))
    copies = queued.filter("first_finish is not null").select("size", epochs.alias("e"), "first_finish", "lap")
    copies = copies.select("size", (F.col("first_finish") + F.col("e") * F.col("lap")).alias("finish")).filter("finish < 2")
    ranges = copies.groupBy(F.floor(F.col("finish") / width).alias("range")).agg(F.sum("size").alias("words"))
    upto = ranges.select("range", "words", F.sum("words").over(Window.orderBy("range")).alias("upto"))
    # one row: the first range in which the budget is exceeded
    last = upto.filter(F.col("upto") > budget * share).orderBy("range").limit(1).first()
    if last is None:
        return 2.0
    inside = copies.filter(F.floor(F.col("finish") / width) == last["range"])
    # copies with one finish time are taken together
    inside = inside.groupBy("finish").agg(F.sum("size").alias("size"))
    inside = inside.select("finish", F.sum("size").over(Window.orderBy("finish")).alias("upto"))
    room = budget * share - (last["upto"] - last["words"])
    end = inside.filter(F.col("upto") <= room).agg(F.max("finish")).first()[0]
    return float(end) if end is not None else last["range"] * width - 1e-12


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents that the mix reads, with their own columns and size, source_size, target, first_finish, copies and taken
    (words); columns of these names are replaced.

    Rows that repeat an id, a source and a size get the plan of one of them.
    """
    key = (F.col(id_col), F.col(source_col), word_count(F.col(text_col)))
    plan = mix_plan(docs, id_col, text_col, source_col, **how).filter("copies > 0")
    first = F.min(F.struct("first_finish", "source_size", "target", "copies")).alias("__plan")
    plan = materialise(plan.groupBy(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("size").alias("__size")).agg(first), "mix-plan")
    rows = docs.withColumn("__words", key[2])
    same = rows[id_col].eqNullSafe(F.col("__id")) & rows[source_col].eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size"))
    out = rows.join(plan, same).withColumns({
        "size": F.col("__size"), **{c: F.col(f"__plan.{c}") for c in ("source_size", "target", "first_finish", "copies")}})
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("__id", "__source", "__size", "__words", "__plan")


def mixed_stream(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", partitions: int = 200) -> DataFrame:
    """The mix itself: every copy of every document read, range-sorted by virtual finish time.  Needs unique ids."""
    copies = plan.filter("copies > 0").select(id_col, "first_finish", F.try_divide("source_size", "target").alias("lap"),
                                              F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
    copies = copies.select(id_col, "epoch", (F.col("first_finish") + F.col("epoch") * F.col("lap")).alias("virtual_finish"))
    return (docs.join(copies, id_col).repartitionByRange(partitions, "virtual_finish", id_col)
            .sortWithinPartitions("virtual_finish", id_col))
