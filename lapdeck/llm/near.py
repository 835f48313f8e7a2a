"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

Texts are sets of hashed word shingles.  With all shingles in one global order (rare ones first), two
sets of sizes n and m whose overlap is large enough for the threshold share at least l of the first
``n - a + l`` and ``m - b + l`` shingles, where a = ceil(t * n) and b = ceil(t * m) are the least overlaps.
Each set picks its own l (1 to ``deepest``) by estimated candidate cost; a pair must share the smaller of
the two l among both prefixes, and is then verified exactly.

Plan (every step moves packed arrays, not one row per shingle):

1. texts -> shingle hashes, dealt by hash range, with the set they belong to;
2. per hash range: shingles that only one set has can match nothing and stop here; the
   others go on to their set, with their document frequency;
3. per set: shared shingles in global order, l, prefix.  A set whose prefix has only own shingles is finished;
4. equal sets become one node.  Nodes joined by prefix shingles that more than ``HOT_LIST`` nodes have
   form families; a family is cut into blocks, and a task counts the overlaps of two blocks in
   memory and returns the links that join components, at most one per node.  For all other pairs, first
   each node is verified against a representative of its lists and components are formed; then
   the candidate pairs between components are counted and verified.  So neither a large group of
   near copies nor a shingle that many texts have makes a row per pair.

Overlaps are counted on shared shingles only, which is exact: a shingle that one set has is in no intersection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches
from lapdeck.llm.components import connected_components

U = np.uint64
KEEP = 48  # bits of a shingle hash that travel, besides those that its range implies
CHARS_PER_RANGE = 2_000_000
FLUSH = 400_000
HOT_LIST = 256
FAMILY_BLOCK = 512


def _bits(chars: int) -> int:
    """log2 of the number of hash ranges."""
    return max(8, min(24, math.ceil(math.log2(max(1, chars / CHARS_PER_RANGE)))))


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())


def _split(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Group parallel arrays by a small integer key: the keys present, and each column's piece by key."""
    order = np.argsort(key, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else np.zeros(0, int)
    return key[order][at], [np.split(c[order], at[1:]) if len(at) else [] for c in columns]


def _shingle_step(kind: str, bits: int, size: int):
    """Step 1: rows of shingles by hash range, and a row of facts per text."""
    keep = min(KEEP, 64 - bits)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, texts = batch.column("sid").to_numpy(), batch.column("text").to_pylist()
            for a, b in tp.parts(texts):
                text, h = tp.shingles(tp.words(texts[a:b]), size)
                n = np.bincount(text, minlength=b - a)
                first = np.concatenate([[0], np.cumsum(n)])
                mixed = [np.concatenate([np.zeros(1, U), np.cumsum(tp.scramble(h ^ k))]) for k in (tp.K1, tp.K2)]
                hi, lo = [(m[first[1:]] - m[first[:-1]]).view(np.int64) for m in mixed]
                ranges = (h >> U(64 - bits)).astype(np.int32)
                rest = (h >> U(64 - bits - keep)) & U((1 << keep) - 1)
                keys, (owners, hashes) = _split(ranges, text.astype(np.uint16), rest)
                packed = [x.view(np.uint8).reshape(-1, 8)[:, :6] for x in hashes]  # little-endian: the low 48 bits
                k, d = len(keys), b - a
                own = tp.scramble(sids[a:b].astype(U)) >> U(64 - bits)
                yield pa.RecordBatch.from_pydict({
                    "range": pa.concat_arrays([pa.array(keys, pa.int32()), pa.array(own.astype(np.int32))]),
                    "sid": pa.concat_arrays([pa.array(np.full(k, sids[a] if d else 0)), pa.array(sids[a:b])]),
                    "owners": pa.concat_arrays([_binary(owners), pa.nulls(d, pa.binary())]),
                    "hashes": pa.concat_arrays([_binary(packed), pa.nulls(d, pa.binary())]),
                    "id": pa.concat_arrays([pa.nulls(k, batch.column("id").type), batch.column("id").slice(a, d)]),
                    "row": pa.concat_arrays([pa.nulls(k, pa.int64()), batch.column("row").slice(a, d)]),
                    "n": pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array(n, pa.int32())]),
                    "hi": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(hi)]),
                    "lo": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(lo)])})

    return step, f"range int, sid long, owners binary, hashes binary, id {kind}, row long, n int, hi long, lo long"


def _shared_step(kind: str, bits: int):
    """Step 2: of a hash range, the shingles that two or more texts have, dealt to their texts with their frequency."""
    keep = min(KEEP, 64 - bits)

    def shared(key: int, rows: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sid = np.concatenate([np.frombuffer(o, np.uint16).astype(np.int64) + s for s, o, _ in rows])
        raw = np.frombuffer(b"".join(h for _, _, h in rows), np.uint8).reshape(-1, 6)
        rest = np.zeros((len(raw), 8), np.uint8)
        rest[:, :6] = raw
        token = (rest.view(U).ravel() << U(64 - bits - keep)) | (U(key) << U(64 - bits))
        order = np.argsort(token, kind="stable")
        token, sid = token[order], sid[order]
        at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        df = np.diff(np.concatenate([at, [len(token)]]))
        df = np.repeat(df, df)
        return sid[df > 1], token[df > 1].view(np.int64), df[df > 1].astype(np.int32)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, ready, size = None, [], [], 0

        def flush() -> pa.RecordBatch:
            sid, token, df = (np.concatenate(x) for x in zip(*ready, strict=True))
            keys, (s, t, d) = _split((tp.scramble(sid.astype(U)) >> U(64 - bits)).astype(np.int32), sid, token, df)
            k = len(keys)
            return pa.RecordBatch.from_pydict({
                "range": pa.array(keys), "sid": pa.nulls(k, pa.int64()), "sids": _binary(s), "tokens": _binary(t), "dfs": _binary(d),
                "id": pa.nulls(k, id_type), "row": pa.nulls(k, pa.int64()), "n": pa.nulls(k, pa.int32()), "hi": pa.nulls(k, pa.int64()),
                "lo": pa.nulls(k, pa.int64())})

        for batch in batches:
            id_type = batch.column("id").type
            facts = batch.filter(pa.compute.is_valid(batch.column("n")))
            if len(facts):
                none = pa.nulls(len(facts), pa.binary())
                yield pa.RecordBatch.from_pydict({c: facts.column(c) for c in ("range", "sid")} | dict.fromkeys(("sids", "tokens", "dfs"), none)
                                                 | {c: facts.column(c) for c in ("id", "row", "n", "hi", "lo")})
            packs = batch.filter(pa.compute.is_null(batch.column("n")))
            for r, s, o, h in zip(*(packs.column(c).to_pylist() for c in ("range", "sid", "owners", "hashes")), strict=True):
                if r != key and rows:
                    ready.append(shared(key, rows))
                    size += len(ready[-1][0])
                    rows = []
                    if size > FLUSH:
                        yield flush()
                        ready, size = [], 0
                key = r
                rows.append((s, o, h))
        if rows:
            ready.append(shared(key, rows))
            size += len(ready[-1][0])
        if size:
            yield flush()

    return step, f"range int, sid long, sids binary, tokens binary, dfs binary, id {kind}, row long, n int, hi long, lo long"


def choose_depth(df: np.ndarray, n: int, least: int, deepest: int, verify: float) -> tuple[int, int]:
    """(l, number of shared shingles in the prefix) of least estimated cost.

    ``df``: frequencies of the set's shared shingles in global order.  Reading the prefix's lists costs the sum of df - 1;
    at most that sum / l sets share l of them and are verified, at ``verify`` each.
    """
    own = n - len(df)
    read = np.concatenate([[0], np.cumsum(df - 1)])
    best = (math.inf, 1, 0)
    for depth in range(1, min(deepest, least) + 1):
        take = min(len(df), n - least + depth - own)
        best = min(best, (float(read[take]) * (1 + verify / depth), depth, take))
    return best[1], best[2]


def _prefix_step(kind: str, per_cent: int, deepest: int, verify: float):
    """Step 3: a row per text; ``depth``, ``prefix`` and ``shared`` only where the text can have a partner."""

    def finish(facts: list[dict], packs: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        sid, token, df = (np.frombuffer(b"".join(p[i] for p in packs), t) for i, t in enumerate((np.int64, U, np.int32)))
        order = np.lexsort((token, df, sid))
        sid, token, df = sid[order], token[order], df[order]
        depth, prefix, shared = [], [], []
        for f in facts:
            a, b = np.searchsorted(sid, (f["sid"], f["sid"] + 1))
            least = -(-per_cent * f["n"] // 100)
            if f["n"] and b - a >= least:
                d, take = choose_depth(df[a:b], f["n"], least, deepest, verify)
                depth.append(d)
                prefix.append(token[a:a + take].view(np.int64))
                shared.append(np.sort(token[a:b]).tobytes())
            else:
                depth.append(None), prefix.append(None), shared.append(None)
        cols = {c: pa.array([f[c] for f in facts], types[c]) for c in ("id", "row", "sid", "n", "hi", "lo")}
        return pa.RecordBatch.from_pydict(cols | {"depth": pa.array(depth, pa.int32()), "prefix": pa.array(prefix, pa.list_(pa.int64())),
                                                  "shared": pa.array(shared, pa.binary())})

    types: dict[str, pa.DataType] = {}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, facts, packs = None, [], []
        for batch in batches:
            types.update({f.name: f.type for f in batch.schema})
            for r in batch.to_pylist():
                if r["range"] != key and facts:
                    yield finish(facts, packs)
                    facts, packs = [], []
                elif r["range"] != key:
                    packs = []
                key = r["range"]
                if r["n"] is None:
                    packs.append((r["sids"], r["tokens"], r["dfs"]))
                else:
                    facts.append(r)
        if facts:
            yield finish(facts, packs)

    return step, f"id {kind}, row long, sid long, n int, hi long, lo long, depth int, prefix array<long>, shared binary"


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, per_cent: int = 75, deepest: int = 4,
                 verify: float = 4.0) -> DataFrame:
    """Steps 1 to 3: a row per text with its set's size, digest, depth, prefix and shared shingles."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    bits = _bits(chars)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 16)
    rows = docs.select(F.monotonically_increasing_id().alias("sid"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"),
                       F.col(text_col).alias("text"))
    for make in (_shingle_step(kind, bits, size), _shared_step(kind, bits)):
        rows = rows.mapInArrow(*make).repartition(parts, "range").sortWithinPartitions("range")
    return rows.mapInArrow(*_prefix_step(kind, per_cent, deepest, verify))


def _verified(pairs: DataFrame, nodes: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shared").alias(f"shared_{x}")) for x in "ab")
    sizes = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab"]
    near = pairs.join(sizes[0], "a").join(sizes[1], "b").filter(100 * F.least("n_a", "n_b") >= per_cent * F.greatest("n_a", "n_b"))
    near = materialise(near.select("a", "b"), "near-pairs")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "shared_a", "shared_b")), strict=True):
                both = len(np.intersect1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True))
                hit.append(100 * both >= per_cent * (n + m - both))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return near.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "shared_a", "shared_b").mapInArrow(verify, "a long, b long")


def _with_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes."""
    comps = connected_components(links).withColumnRenamed("node", "linked")
    both = nodes.select("node").join(comps, F.col("node") == F.col("linked"), "left")
    return materialise(both.select("node", F.coalesce("comp", "node").alias("comp")), "near-comps")


def _spanning_links(n: np.ndarray, sets: list[np.ndarray], split: int, per_cent: int) -> list[tuple[int, int]]:
    """Similar pairs among ``sets`` (numbers), as few as keep their components; with ``split``, only pairs across it."""
    size = len(sets)
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    both = np.zeros((size, size), np.int32)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a > 1:
            m = owner[a:b]
            both[m[:, None], m[None, :]] += 1
    similar = 100 * both >= per_cent * (n[:, None] + n[None, :] - both)
    similar[np.tril_indices(size)] = False
    if split:
        similar[:split, :split] = similar[split:, split:] = False
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(similar)), strict=True):
        a, b = root(i), root(j)
        if a != b:
            parent[b] = a
            links.append((i, j))
    return links


def _family_links(families: DataFrame, nodes: DataFrame, per_cent: int) -> DataFrame:
    """(a, b): links that join the components within each family (node, family), all of its pairs considered."""
    size = materialise(families.groupBy("family").agg(F.ceil(F.count("*") / FAMILY_BLOCK).cast("int").alias("blocks")), "near-families")
    rows = families.join(size, "family").join(nodes.select("node", "n", "shared"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("family", "node", "n", "shared", own.alias("own"), other.alias("other"))
    key = ["family", "i", "j"]
    rows = rows.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "shared")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *key).sortWithinPartitions(*key, "own", "node")

    def links(rows: list[dict]) -> pa.RecordBatch:
        split = 0 if rows[0]["i"] == rows[0]["j"] else sum(r["own"] == rows[0]["i"] for r in rows)
        found = _spanning_links(np.array([r["n"] for r in rows]), [np.frombuffer(r["shared"], U) for r in rows], split, per_cent)
        return pa.RecordBatch.from_pydict({"a": pa.array([rows[i]["node"] for i, _ in found], pa.int64()),
                                           "b": pa.array([rows[j]["node"] for _, j in found], pa.int64())})

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["family"], r["i"], r["j"]) != at and block:
                    yield links(block)
                    block = []
                at = (r["family"], r["i"], r["j"])
                block.append(r)
        if block:
            yield links(block)

    return rows.mapInArrow(step, "a long, b long")


def link_components(nodes: DataFrame, per_cent: int = 75, hot_list: int = HOT_LIST) -> DataFrame:
    """(node, comp) from nodes (node, n, depth, prefix, shared): the components of all links."""
    postings = materialise(nodes.select("node", "n", "depth", F.explode("prefix").alias("token")), "near-postings")

    # pairs that share a hot prefix shingle are in one family, and all pairs of a family are considered there
    counts = postings.groupBy("token").agg(F.count("*").alias("size"), F.min("node").alias("least"))
    hot = materialise(counts.filter(F.col("size") > hot_list).select("token", "least"), "near-hot")
    joined = postings.join(hot, "token").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    families = materialise(connected_components(joined).select("node", F.col("comp").alias("family")), "near-families")
    links = materialise(_family_links(families, nodes, per_cent), "near-links")
    comps = _with_components(nodes, links)
    known = nodes.select("node", "n", "depth", "prefix").join(families, "node", "left")
    postings = known.select("node", "n", "depth", "family", F.explode("prefix").alias("token"))
    postings = materialise(postings.join(hot.select("token"), "token", "left_anti"), "near-postings")

    def lists(rows: DataFrame, by: str) -> DataFrame:
        """Shingles whose nodes have two or more values of ``by``; with the smallest."""
        facts = rows.groupBy("token").agg(F.min(by).alias("least"), F.max(by).alias("most"))
        return materialise(facts.filter("least <> most").select("token", "least"), "near-lists")

    # each node against the representative that it shares most shingles with
    tagged = materialise(postings.join(comps, "node"), "near-tagged")
    stars = tagged.join(lists(tagged, "comp"), "token").filter("comp <> least")
    stars = stars.groupBy(F.col("node").alias("a"), F.col("least").alias("b")).count()
    best = Window.partitionBy("a").orderBy(F.desc("count"), "b")
    pairs = materialise(stars.withColumn("k", F.row_number().over(best)).filter("k = 1").select("a", "b"), "near-stars")
    links = materialise(links.unionByName(_verified(pairs, nodes, per_cent)), "near-links")
    comps = _with_components(nodes, links)

    # then every candidate pair between components; a pair of one family has been considered
    tagged = materialise(postings.join(comps, "node"), "near-tagged")
    mixed = materialise(tagged.join(lists(tagged, "comp").select("token"), "token", "left_semi"), "near-mixed")
    x, y = (mixed.select("token", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "comp", "n", "depth", "family")]) for k in "ab")
    apart = (F.col("comp_a") > F.col("comp_b")) & ~F.coalesce(F.col("family_a") == F.col("family_b"), F.lit(False))
    cross = x.join(y, "token").filter(apart & (100 * F.least("n_a", "n_b") >= per_cent * F.greatest("n_a", "n_b")))
    cross = cross.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.least("depth_a", "depth_b").alias("need")).count()
    cross = cross.filter(F.col("count") >= F.col("need")).select("a", "b")
    cross = materialise(cross.join(pairs, ["a", "b"], "left_anti"), "near-cross")
    links = materialise(links.unionByName(_verified(cross, nodes, per_cent)), "near-links")
    return _with_components(nodes, links)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, per_cent: int = 75, hot_list: int = HOT_LIST, **cost) -> DataFrame:
    """One row per document: id, row (hash of the text), n_shingles, component_id, is_first.

    Two texts link when 100 * intersection >= ``per_cent`` * union of their sets; ``component_id`` is the smallest id that links reach
    (null ids are passed over; null if there is no other).  A text with fewer than ``size`` words has its word sequence as its one
    shingle; null and wordless texts have none, link with nothing and are their own component.  ``is_first`` marks the document of
    each component with the smallest (id, text hash), null ids last; repeated rows are marked alike.
    An empty table gives no rows; other columns are ignored.
    """
    sets = materialise(shingle_sets(docs, id_col, text_col, size, per_cent, **cost), "near-sets")
    full = sets.filter("n > 0")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    digest = ["n", "hi", "lo"]
    groups = materialise(full.groupBy(*digest).agg(F.min("sid").alias("node"), F.min(rank).alias("first")), "near-groups")
    nodes = full.filter("depth is not null").join(groups.select(F.col("node").alias("sid")), "sid", "left_semi")
    nodes = materialise(nodes.select(F.col("sid").alias("node"), "n", "depth", "prefix", "shared"), "near-nodes")
    comps = link_components(nodes, per_cent, hot_list)
    grouped = groups.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    grouped = materialise(grouped, "near-grouped")
    heads = materialise(grouped.groupBy("comp").agg(F.min("first").alias("head")), "near-heads")
    by_set = materialise(grouped.join(heads, "comp").select(*digest, F.col("head.id").alias("component_id"), F.col("head.row").alias("head_row")), "near-by-set")
    own = (F.col("id").eqNullSafe(F.col("component_id"))) & (F.col("row") == F.col("head_row"))
    out = full.select("id", "row", *digest).join(by_set, digest).select("id", "row", "n", "component_id", own.alias("is_first"))
    bare = sets.filter("n = 0").select("id", "row", "n", F.col("id").alias("component_id"), F.lit(True).alias("is_first"))
    return out.unionByName(bare).select(F.col("id").alias(id_col), "row", F.col("n").cast("long").alias("n_shingles"), "component_id", "is_first")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each component; rows that repeat an id and a text are one document."""
    firsts = near_groups(docs, id_col, text_col, **how).filter("is_first").select(F.col(id_col).alias("__id"), F.col("row").alias("__row"))
    firsts = materialise(firsts.distinct(), "near-firsts")
    rows = docs.withColumn("__text", F.xxhash64(text_col))
    kept = rows.join(firsts, rows[id_col].eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__row")), "left_semi")
    copy = Window.partitionBy(id_col, "__text").orderBy(F.lit(0))
    return kept.withColumn("__copy", F.row_number().over(copy)).filter("__copy = 1").drop("__text", "__copy")
