"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's terms over all passages (64 words each) of the corpus.
2. Distributed randomised SVD of the passages' TF-IDF matrix A (terms that no benchmark passage has
   cannot raise a similarity and are left out): tasks add up their part of ``A^T (A G)`` for a random G, and the small
   result gives the leading right singular vectors V (Nystroem: ``A^T A`` is about ``Z (G^T Z)^-1 Z^T``).
3. Places with enough of a passage's rarest words (an exact bound, see ``Searcher``) are cut into windows at the passage's
   own scale and projected on V; windows with a latent cosine of at least ``cosine`` to the passage are candidates.
4. A candidate is verified on its words: longest common subsequence, and for paraphrases with a
   lower share of it, the item's answer (its last sentence).

The benchmark is a stated query set: it is searched in blocks of ``block`` passages, so what a task holds is bounded.
Window sums are differences of running sums, taken in blocks of ``STEP`` words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches

BITS = 18  # hashed terms
PASSAGE = 64
SCALES = (16, 32, 64)
STEP = 4_096
SPREAD = 2  # a leak lies within so many times its passage's words
SLICE = 128  # terms per row of the sketch
SENTENCE = re.compile(r"[.!?]+[\x20\x09-\x0D]+|\n")


@dataclass
class Queries:
    """Benchmark passages of at most ``PASSAGE`` words."""

    item: list[int] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    answer: list[int] = field(default_factory=list)  # words of the answer at the passage's end, 0 without

    @classmethod
    def of(cls, items: list[tuple[int, str | None]]) -> Queries:
        q = cls()
        for item, text in items:
            h = tp.word_hashes(tp.words([text]))
            if not len(h):
                continue
            tail = len(tp.words([SENTENCE.split((text or "").strip())[-1]]).start)
            pieces = np.array_split(h, -(-len(h) // PASSAGE))
            for k, piece in enumerate(pieces):
                last = k == len(pieces) - 1
                q.item.append(item)
                q.words.append(piece)
                q.answer.append(min(tail, len(piece)) if last and tail < len(h) else 0)
        return q


class Terms:
    """The benchmark's hashed terms; ``of`` numbers a text's words, ``size`` standing for all others."""

    def __init__(self, q: Queries):
        seen = np.unique(np.concatenate([w >> tp.U(64 - BITS) for w in q.words]).astype(np.int64)) if q.words else np.zeros(0, np.int64)
        self.size = len(seen)
        self.table = np.full(1 << BITS, self.size, np.int32)
        self.table[seen] = np.arange(self.size)

    def of(self, h: np.ndarray) -> np.ndarray:
        return self.table[(h >> tp.U(64 - BITS)).astype(np.int64)]


def _passages(batch: pa.RecordBatch, terms: Terms) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(passage, term) of the benchmark's terms in a batch's texts, and the number of passages."""
    texts = batch.column("text").to_pylist()
    for a, b in tp.parts(texts, 1_000_000):
        w = tp.words(texts[a:b])
        if not len(w.start):
            continue
        first = w.first
        place = np.arange(len(w.start)) - first[w.text]
        new = place % PASSAGE == 0
        passage = np.cumsum(new) - 1
        term = terms.of(tp.word_hashes(w))
        known = term < terms.size
        yield passage[known], term[known], int(new.sum())


def term_weights(docs: DataFrame, terms: Terms, text_col: str) -> np.ndarray:
    """Squared inverse document frequency of the terms over all passages of all texts (squared, so that the many
    fairly common words of a language don't fill the latent space)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        df, n = np.zeros(t.size + 1, np.int64), 0
        for batch in batches:
            for passage, term, k in _passages(batch, t):
                pairs = np.unique(passage * (t.size + 1) + term)
                df += np.bincount(pairs % (t.size + 1), minlength=t.size + 1)
                n += k
        df[t.size] = n  # the last place counts passages
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "df": pa.array(df[at])})

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(terms.size + 1)
    for r in counts.collect():  # one row per term of the block
        df[r["term"]] = r["df"]
    return (np.log((df[-1] + 1.0) / (df[:-1] + 1.0)) + 0.1) ** 2


def add_products(z: np.ndarray, start: np.ndarray, passage: np.ndarray, term: np.ndarray) -> None:
    """z += C^T (C start) for the counts C of these passages; one entry per word."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(passage) != 0]))
    y = np.add.reduceat(start[term], at, axis=0)  # passages x width
    which = np.repeat(np.arange(len(at)), np.diff(np.concatenate([at, [len(term)]])))
    order = np.argsort(term, kind="stable")
    term, which = term[order], which[order]
    at = np.flatnonzero(np.concatenate([[True], np.diff(term) != 0]))
    z[term[at]] += np.add.reduceat(y[which], at, axis=0)


def latent_space(docs: DataFrame, terms: Terms, idf: np.ndarray, text_col: str, rank: int, extra: int = 8, seed: int = 1) -> np.ndarray:
    """V: the leading right singular vectors (terms x rank) of the TF-IDF passages, by one distributed pass."""
    width = min(rank + extra, terms.size)
    g = np.random.default_rng(seed).standard_normal((terms.size, width))
    shared = docs.sparkSession.sparkContext.broadcast((terms, idf, seed, width))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, weight, s, w = shared.value
        start = (np.random.default_rng(s).standard_normal((t.size, w)) * weight[:, None]).astype(np.float32)
        z = np.zeros((t.size, w))
        for batch in batches:
            for passage, term, _ in _passages(batch, t):
                if len(term):
                    add_products(z, start, passage, term)
        z *= weight[:, None]
        slices = range(0, t.size, SLICE)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(slices), pa.int32()),
                                          "z": pa.array([z[i:i + SLICE].tobytes() for i in slices], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, z in zip(batch.column("slice").to_pylist(), batch.column("z").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(z)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "z": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(sketch, "slice int, z binary")
    summed = parts.repartition("slice").mapInArrow(add, "slice int, z binary")
    z = np.zeros((terms.size, width))
    for r in summed.collect():  # terms x width numbers in all
        z[r["slice"]:r["slice"] + SLICE] = np.frombuffer(r["z"]).reshape(-1, width)
    core = g.T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(initial=0.0), 1e-30)
    half = z @ (vectors[:, good] / np.sqrt(values[good]))
    return np.linalg.svd(half, full_matrices=False)[0][:, :rank]


def common_words(pattern: dict[int, int], size: int, region: list[int]) -> int:
    """Length of the longest common subsequence; ``pattern`` has the bit set of each word's places in the query."""
    full = (1 << size) - 1
    v = full
    for w in region:
        u = v & pattern.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


class Searcher:
    """Finds a block's passages in texts: rare words first, then the latent cosine, then the words themselves.

    A common subsequence of ``least`` words misses at most ``size - least`` of a passage's words, so of its rarest
    ``size - least + m`` it has at least ``m``, whatever the words: places without ``m`` of them within ``SPREAD`` passages' lengths hold
    no leak.  Only windows there are projected.
    """

    def __init__(self, q: Queries, terms: Terms, vectors: np.ndarray, idf: np.ndarray, cosine: float, similar: float, paraphrase: float):
        self.q, self.terms, self.limits = q, terms, (cosine, similar, paraphrase)
        self.vectors = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        at = [terms.of(w) for w in q.words]
        latent = np.array([self.vectors[t].sum(0) for t in at])
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        self.latent = latent / np.maximum(norm, 1e-30)
        self.size = size = np.array([len(w) for w in q.words])
        # a passage is sought at its nearest scale, and below it at one that lies inside it wherever windows begin
        nearest = np.argmin(np.abs(np.log(size)[:, None] - np.log(SCALES)[None, :]), axis=1)
        self.scales = [[s for j, s in enumerate(SCALES) if j == near or s <= z <= 2.2 * s] for near, z in zip(nearest, size, strict=True)]
        self.rare = np.zeros(len(at), np.int64)
        pairs = []
        for k, t in enumerate(at):
            least = self.least(k)
            self.rare[k] = m = -(-least // 3)
            rarest = np.argsort(-idf[t], kind="stable")[:len(t) - least + m]
            pairs.append(np.stack([np.unique(t[rarest]), np.full(len(np.unique(t[rarest])), k)]))
        term, passage = np.concatenate(pairs, axis=1)
        order = np.argsort(term, kind="stable")
        self.passage = passage[order].astype(np.int32)  # passages by rare term
        self.first = np.searchsorted(term[order], np.arange(terms.size + 2))
        self.pattern: dict[int, dict[int, int]] = {}

    def least(self, k: int) -> int:
        """Words that a common subsequence with passage ``k`` must have to be a leak."""
        size, (_, similar, paraphrase) = len(self.q.words[k]), self.limits
        if size < 12:
            return size
        return int(np.ceil(size * (min(similar, paraphrase) if self.q.answer[k] >= 4 else similar) - 1e-9))

    def places(self, term: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, first word, last word) of the places with enough rare words of a passage, by passage."""
        count = np.diff(self.first)[term]
        word = np.repeat(np.arange(len(term)), count)
        at = np.cumsum(count) - count
        passage = self.passage[np.arange(len(word)) - np.repeat(at, count) + np.repeat(self.first[term], count)]
        order = np.argsort(passage.astype(np.uint16) if len(self.size) < 1 << 16 else passage, kind="stable")  # words stay in order
        word, passage = word[order], passage[order]
        last = np.arange(len(word)) + self.rare[passage] - 1
        inside = last < len(word)
        word, passage, end, kind = word[inside], passage[inside], word[last[inside]], passage[last[inside]]
        dense = (kind == passage) & (text[end] == text[word]) & (end - word < SPREAD * self.size[passage])
        word, passage, end = word[dense], passage[dense], end[dense]
        new = np.ones(len(word), bool)
        new[1:] = (passage[1:] != passage[:-1]) | (word[1:] > end[:-1])
        at = np.flatnonzero(new)
        return passage[at], word[at], end[np.append(at[1:], len(word)) - 1] if len(at) else end

    def find(self, texts: list[str | None]) -> list[tuple]:
        """(text, item, start, end, cosine, lcs, answer) of every contamination."""
        w = tp.words(texts)
        if not len(w.start):
            return []
        h = tp.word_hashes(w)
        term, first = self.terms.of(h), w.first
        hits: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for k, low, high in zip(*(x.tolist() for x in self.places(term, w.text)), strict=True):
            text, size = int(w.text[low]), int(self.size[k])
            a, b = max(int(first[text]), low - size), min(int(first[text + 1]), high + size + 1)
            for block in range(a, b, STEP):  # however long the place is
                self._windows(term, k, block, min(b, block + STEP), b, hits.setdefault((text, k), []))
        return self._verify(w, h, first, {at: found for at, found in hits.items() if found})

    def _windows(self, term: np.ndarray, k: int, a: int, stop: int, b: int, found: list[tuple[int, int, float]]) -> None:
        """The windows that begin in ``a`` to ``stop`` and end by ``b`` whose latent cosine with passage ``k`` is high enough."""
        sums = np.zeros((min(b, stop + max(SCALES)) - a + 1, self.vectors.shape[1]), np.float32)
        np.cumsum(self.vectors[term[a:a + len(sums) - 1]], axis=0, out=sums[1:])
        for scale in self.scales[k]:
            start = np.arange(0, stop - a, scale // 4)
            end = np.minimum(start + scale, len(sums) - 1)
            x = sums[end] - sums[start]
            cos = x @ self.latent[k] / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-6)
            for i in np.flatnonzero(cos >= self.limits[0]).tolist():
                found.append((a + int(start[i]), a + int(end[i]), float(cos[i])))

    def _places_in(self, k: int) -> dict[int, int]:
        """The bit set of each word's places in passage ``k``."""
        if k not in self.pattern:
            places: dict[int, int] = {}
            for i, x in enumerate(self.q.words[k].tolist()):
                places[x] = places.get(x, 0) | 1 << i
            self.pattern[k] = places
        return self.pattern[k]

    def _verify(self, w: tp.Words, h: np.ndarray, first: np.ndarray, hits: dict) -> list[tuple]:
        found = []
        chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        for (text, k), windows in hits.items():
            size, best = len(self.q.words[k]), None
            regions: list[list] = []
            for a, b, c in sorted(windows):  # windows that touch are one region
                if regions and a <= regions[-1][1]:
                    regions[-1][1], regions[-1][2] = max(b, regions[-1][1]), max(c, regions[-1][2])
                else:
                    regions.append([a, b, c])
            pattern = self._places_in(k)
            for a, b, c in regions:
                a, b = max(first[text], a - size // 2), min(first[text + 1], b + size // 2)
                region = h[a:b].tolist()
                known = [x in pattern for x in region]
                if sum(known) < self.limits[2] * size:  # bounds the common subsequence
                    continue
                lcs = common_words(pattern, size, region) / size
                n = self.q.answer[k]
                answer = 0.0
                if n:
                    tail = {x: p >> (size - n) for x, p in pattern.items() if p >> (size - n)}
                    answer = common_words(tail, n, region) / n
                _, similar, paraphrase = self.limits
                leak = lcs >= (similar if size >= 12 else 0.999) or (size >= 12 and n >= 4 and lcs >= paraphrase and answer >= 0.9)
                if leak and (best is None or lcs > best[3]):
                    inside = [i for i, y in enumerate(known) if y]
                    s, e = a + inside[0], a + inside[-1]
                    base = chars[w.text_at[text]]
                    best = (int(chars[w.start[s]] - base), int(chars[w.start[e] + w.size[e]] - base), c, lcs, answer)
            if best:
                found.append((text, self.q.item[k], *best))
        return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", rank: int = 64, cosine: float = 0.25, similar: float = 0.75, paraphrase: float = 0.6, block: int = 4_000) -> DataFrame:
    """One row per document and benchmark item that it contains: id, row (hash of the text), item_id, start, end, cosine, lcs, answer.

    A passage of an item is contained when ``similar`` of its words are a common subsequence with a region of the text (all of them
    for passages under 12 words), or ``paraphrase`` of them and 0.9 of its answer.  The region has at most ``SPREAD`` times the passage's
    words.  ``cosine`` is far below what such pairs usually have, as the words around a passage lower it; recall is in README.  Null and wordless texts and items match nothing; repeated rows give repeated
    results; an empty table on either side gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row long, item_id long, start int, end int, cosine double, lcs double, answer double"
    out, queries = None, Queries()

    def search(q: Queries) -> DataFrame:
        terms = Terms(q)
        idf = term_weights(docs, terms, text_col)
        vectors = latent_space(docs, terms, idf, text_col, rank) * idf[:, None]
        shared = spark.sparkContext.broadcast((q, terms, vectors, idf))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = Searcher(*shared.value, cosine, similar, paraphrase)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                for a, b in tp.parts(texts, 1_000_000):
                    if rows := s.find(texts[a:b]):
                        text, item, start, end, cos, lcs, answer = zip(*rows, strict=True)
                        take = pa.array([t + a for t in text])
                        yield pa.RecordBatch.from_pydict({
                            "id": batch.column("id").take(take), "row": batch.column("row").take(take), "item_id": pa.array(item, pa.int64()),
                            "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()), "cosine": pa.array(cos), "lcs": pa.array(lcs),
                            "answer": pa.array(answer)})

        rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
        found = materialise(rows.mapInArrow(step, schema), "leaks")
        # an item in several passages: its best
        best = F.max_by(F.struct("start", "end", "cosine", "answer"), F.struct("lcs", -F.col("start")))
        return found.groupBy("id", "row", "item_id").agg(F.max("lcs").alias("lcs"), best.alias("at"))

    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).toLocalIterator()
    for r in rows:
        one = Queries.of([(r["item"], r["text"])])
        queries.item += one.item
        queries.words += one.words
        queries.answer += one.answer
        if len(queries.item) >= block:
            part, queries = search(queries), Queries()
            out = part if out is None else out.unionByName(part)
    if queries.item:
        part = search(queries)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"id {kind}, row long, item_id long, lcs double, at struct<start:int,end:int,cosine:double,answer:double>")
    return out.select(F.col("id").alias(id_col), "row", "item_id", "at.start", "at.end", F.round("at.cosine", 4).alias("cosine"), "lcs", "at.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without those that contain a benchmark item, with their own columns.

    Null and wordless texts stay, rows that repeat an id and text go or stay alike, and an empty table on either side removes nothing.
    """
    bad = find_leaks(docs, benchmark, id_col, text_col, **how).select(F.col(id_col).alias("__id"), F.col("row").alias("__row")).distinct()
    return docs.join(materialise(bad, "leaking"), docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__row")), "left_anti")
