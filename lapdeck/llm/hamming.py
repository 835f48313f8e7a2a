"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into ``segments`` pieces; for each piece the codes are sorted by its value.  Round r
probes every segment of a query with all values at distance r from its own.  Two codes at
distance d agree within ``d // segments`` on some segment, so after round r all codes closer than
``segments * (r + 1)`` have been seen.  A query ends when its k-th best verified distance is below that
bound (or it has all codes); else it goes on to radius r + 1.

The codes are dealt over tasks, which index their own and answer all queries; a task's k best hold every
one of its codes that is among the k best of all, so merging them is exact.  The queries are a stated
set and go out in blocks of ``block`` codes.  With the square root of the number of codes as the number of
tasks, neither a task's index nor the merged answers grow as fast as the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm.common import materialise

U = np.uint64
CODES_PER_TASK = 1_024  # tasks: the root of (codes / this)


def sign_code(vector: Column, bits: int = 64) -> Column:
    """Bit i (from the lowest) says that component i is at least 0; null for null vectors, other lengths and null components."""
    bit = F.transform(vector, lambda x, i: F.when(x >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bit, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when((F.size(vector) == bits) & ~F.exists(vector, F.isnull), code)


@cache
def _masks(width: int, radius: int) -> np.ndarray:
    """All ``width``-bit values with ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(width), radius)], U)


class Index:
    """Multi-index over distinct codes; ``rows`` tells how many rows (k at most) have each code."""

    def __init__(self, codes: np.ndarray, rows: np.ndarray, bits: int = 64, segments: int | None = None):
        self.codes, self.rows = codes, rows
        self.segments = segments or max(1, round(bits / max(8, len(codes).bit_length())))
        edges = [bits * s // self.segments for s in range(self.segments + 1)]
        self.cuts = [(U(a), b - a, U((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        self.order, self.values = [], []
        for shift, _, mask in self.cuts:
            value = (codes >> shift) & mask
            self.order.append(np.argsort(value, kind="stable"))
            self.values.append(value[self.order[-1]])

    def nearest(self, query: U, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(codes' numbers, distances) of the codes that hold the ``k`` nearest rows, all ties at the last distance included."""
        seen = np.zeros(len(self.codes), bool)
        need, found, distance = min(k, int(self.rows.sum())), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(w for _, w, _ in self.cuts) + 1):
            for (shift, width, mask), order, values in zip(self.cuts, self.order, self.values, strict=True):
                if radius <= width:
                    probe = ((query >> shift) & mask) ^ _masks(width, radius)
                    start, stop = np.searchsorted(values, probe, "left"), np.searchsorted(values, probe, "right")
                    size = stop - start
                    hit = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    hit = order[hit]
                    hit = np.unique(hit[~seen[hit]])
                    seen[hit] = True
                    found = np.concatenate([found, hit])
                    distance = np.concatenate([distance, np.bitwise_count(self.codes[hit] ^ query).astype(np.int64)])
            covered = distance < self.segments * (radius + 1)
            if self.rows[found[covered]].sum() >= need:
                break
        order = np.argsort(distance, kind="stable")
        found, distance = found[order], distance[order]
        before = np.cumsum(self.rows[found]) - self.rows[found]  # rows of nearer or equal codes before it
        last = distance[before < k].max(initial=-1)
        return found[distance <= last], distance[distance <= last]


def _nearest_entries(queries: list[int], entries: DataFrame, k: int, bits: int, segments: int | None) -> DataFrame:
    """(q, code, n, distance): for a block of query codes, each task's nearest entries (code, n)."""
    asked = np.array(queries, np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("code").to_numpy(), b.column("n").to_numpy()) for b in batches if len(b)]
        if not parts:
            return
        codes, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
        index = Index(codes.view(U), rows, bits, segments)
        for q in asked:
            at, distance = index.nearest(q.view(U), k)
            yield pa.RecordBatch.from_pydict({"q": pa.array(np.full(len(at), q)), "code": pa.array(codes[at]), "n": pa.array(rows[at]),
                                              "distance": pa.array(distance, pa.int32())})

    return entries.mapInArrow(search, "q long, code long, n long, distance int")


def search(queries: DataFrame, rows: DataFrame, k: int = 10, bits: int = 64, segments: int | None = None, block: int = 20_000) -> DataFrame:
    """The ``k`` rows nearest to each query by Hamming distance; ties by the smaller row id.

    Both tables have (id long, code long); other columns are ignored, whatever their names.  Null codes and null ids are left out.  Returns query_id, neighbor_id,
    distance, rank; a query gets fewer than ``k`` rows only if the table has fewer.

    Equal codes are one entry, which keeps the ``k`` smallest ids that have it (no other row with that
    code can be among the k nearest); equal query codes are searched once.  So a vector that a
    third of all rows share is one entry.  A repeated id counts once.
    """
    ids = Window.partitionBy("code").orderBy("id")
    queries, rows = queries.select("id", "code"), rows.select("id", "code")
    rows = rows.filter("id is not null and code is not null").dropDuplicates(["id", "code"])
    copies = materialise(rows.withColumn("copy", F.row_number().over(ids)).filter(F.col("copy") <= k), "mih-rows")
    entries = materialise(copies.groupBy("code").agg(F.count("*").alias("n")), "mih-codes")
    tasks = math.ceil(math.sqrt(max(1, entries.count()) / CODES_PER_TASK))
    entries = entries.repartition(tasks)
    asked = queries.filter("id is not null and code is not null").dropDuplicates(["id", "code"])
    asked = materialise(asked, "mih-queries")
    found, part = None, []

    def run(codes: list[int]) -> DataFrame:
        near = _nearest_entries(codes, entries, k, bits, segments)
        # an entry stays while the entries strictly nearer than it hold fewer than k rows
        nearer = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        kept = near.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).filter(F.col("before") < k)
        return materialise(kept.select("q", "code", "distance"), "mih-found")

    for r in asked.select("code").distinct().toLocalIterator():  # a block at a time
        part.append(r["code"])
        if len(part) >= block:
            found = run(part) if found is None else found.unionByName(run(part))
            part = []
    if part or found is None:
        found = run(part) if found is None else found.unionByName(run(part))
    pairs = found.join(copies.select("code", "id"), "code")
    order = Window.partitionBy("q").orderBy("distance", "id")
    top = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    top = top.select(F.col("q").alias("code"), F.col("id").alias("neighbor_id"), "distance", "rank")
    return asked.join(top, "code").select(F.col("id").alias("query_id"), "neighbor_id", "distance", "rank")
