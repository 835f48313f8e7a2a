"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

1. Words are counted over all texts; a batch of texts is counted in its task before anything is shuffled.
2. A word is a point: how often it has each letter.  One replaced letter moves it by an L1 distance of two (one count up, one
   down), one inserted or deleted letter by one.  For each word length, a k-d tree, fitted on a bounded sample of words, cuts the
   space into boxes of about ``leaf`` words.  Every word goes to its own box, and as a question to each box of its own length
   within that distance (only those behind its own, as nearness is mutual) and to each box of the next length within one.
   Boxes are disjoint and cover the space, so the sample decides the balance only, never the result.
3. In each box a k-d tree over its words is searched the same way, and the letters of what is left are compared in order.
4. Forms are followed to their roots by doubling steps; a form has at least twice the count, so chains are short.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapdeck.llm.common import materialise, small_batches, smallest_hashes

RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Letters have one byte each in Latin-1; their number in a point.
LETTER = np.zeros(256, np.int64)
LETTER[97:123] = np.arange(26)
LETTER[0xC0:0x100] = np.arange(26, 90)
LETTERS = 90
DROP = 97  # one run in so many loses a letter
OWN, SAME, SHORTER = 0, 1, 2


# ------------------------------------------------------------------------------------------ words
def misspelt(doc: str, run: str) -> str:
    """The lower-cased run, or what is left of it when the contract's hash of document and run takes a letter out."""
    h = zlib.crc32(f"{doc}:{run}".encode("utf-8", "surrogatepass"))
    return run if h % DROP else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` letters and ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # lower() of bytes changes A-Z only
                runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))) if text else {}
                so_far = zlib.crc32(f"{doc}:".encode("utf-8", "surrogatepass"))
                for run, n in runs.items():
                    if len(run) >= min_length:
                        if not zlib.crc32(run.encode(), so_far) % DROP:
                            run = misspelt(doc, run)
                            if len(run) < min_length:
                                continue
                        total[run] += n
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def codes(words: list[str], size: int) -> np.ndarray:
    """The letters of words of ``size`` letters, as bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def points(code: np.ndarray) -> np.ndarray:
    out = np.zeros((len(code), LETTERS), np.int32)
    np.add.at(out, (np.repeat(np.arange(len(code)), code.shape[1]), LETTER[code].ravel()), 1)
    return out


# ------------------------------------------------------------------------------------------ trees
@dataclass
class Tree:
    """A k-d tree: at an inner node, points with at most ``cut`` of letter ``dim`` are in ``left``, others in ``right``.
    A leaf has ``dim`` -1 and in ``left`` its number."""

    dim: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    leaves: int = 0

    @classmethod
    def over(cls, at: np.ndarray, leaf: float, keep: Callable[[int, np.ndarray], None] | None = None) -> Tree:
        """A tree over points, halved as evenly as any letter can until at most ``leaf`` are left.  ``keep`` gets each leaf's points."""
        tree = cls([], [], [], [])
        todo = [(np.arange(len(at)), -1, False)]
        while todo:
            own, parent, right = todo.pop()
            node = len(tree.dim)
            if parent >= 0:
                (tree.right if right else tree.left)[parent] = node
            here = at[own]
            dim, cut = cls._halves(here) if len(own) > leaf else (-1, 0)
            tree.dim.append(dim)
            tree.cut.append(cut)
            tree.right.append(-1)
            tree.left.append(-1 if dim >= 0 else tree.leaves)
            if dim < 0:
                if keep:
                    keep(tree.leaves, own)
                tree.leaves += 1
                continue
            low = here[:, dim] <= cut
            todo += [(own[~low], node, True), (own[low], node, False)]
        return tree

    @staticmethod
    def _halves(here: np.ndarray) -> tuple[int, int]:
        most = here.max(0)
        best = (len(here), -1, 0)  # only equal points cannot be cut
        for cut in range(min(int(most.max()), 4)):
            low = (here <= cut).sum(0)
            uneven = np.where((low > 0) & (low < len(here)), np.abs(2 * low - len(here)), len(here))
            dim = int(uneven.argmin())
            best = min(best, (int(uneven[dim]), dim, cut))
        if best[1] < 0 and len(here) and (most > here.min(0)).any():  # letters that differ only above those cuts
            dim = int((most - here.min(0)).argmax())
            best = (0, dim, int((most[dim] + here[:, dim].min()) // 2))
        return best[1], best[2]

    def within(self, at: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indices of the points) from which the leaf's box can be reached with ``up`` letters more and ``down`` fewer."""
        none = np.zeros(len(at), np.int32)
        todo = [(0, np.arange(len(at)), none, none, {})]
        while todo:
            node, own, more, fewer, box = todo.pop()
            if not len(own):
                continue
            d = self.dim[node]
            if d < 0:
                yield self.left[node], own
                continue
            low, high = box.get(d, (0, 1 << 30))
            x, cut = at[own, d], self.cut[node]
            f = fewer + np.maximum(x - cut, 0) - np.maximum(x - high, 0)
            m = more + np.maximum(cut + 1 - x, 0) - np.maximum(low - x, 0)
            a, b = f <= down, m <= up
            todo.append((self.left[node], own[a], more[a], f[a], box | {d: (low, cut)}))
            todo.append((self.right[node], own[b], m[b], fewer[b], box | {d: (cut + 1, high)}))


@dataclass
class Boxes:
    """By word length: the number of its first box, and its tree."""

    first: dict[int, int]
    tree: dict[int, Tree]

    @classmethod
    def fit(cls, lengths: dict[int, int], sample: dict[int, list[str]], leaf: int) -> Boxes:
        """``lengths``: number of words by length; ``sample``: some of them.  Boxes get about ``leaf`` words, fewer if they are long."""
        first, trees, n = {}, {}, 0
        for size in sorted(lengths):
            some = sample.get(size, [])
            few = max(16, min(leaf, 1_000_000 // size)) * len(some) / max(1, lengths[size])
            trees[size] = Tree.over(points(codes(some, size)), max(few, 8.0))
            first[size] = n
            n += trees[size].leaves
        return cls(first, trees)

    def deal(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(box, kind, indices of the words) of every word's own box and of the boxes that it has to ask."""
        size = np.array([len(w) for w in words])
        for k in np.unique(size).tolist():
            at = np.flatnonzero(size == k)
            p = points(codes([words[i] for i in at], k))
            own = np.zeros(len(at), np.int64)
            for box, some in self.tree[k].within(p, 0, 0):
                own[some] = box
                yield self.first[k] + box, OWN, at[some]
            for box, some in self.tree[k].within(p, 1, 1):
                some = some[own[some] < box]
                yield self.first[k] + box, SAME, at[some]
            if k + 1 in self.tree:
                for box, some in self.tree[k + 1].within(p, 1, 0):
                    yield self.first[k + 1] + box, SHORTER, at[some]


# ------------------------------------------------------------------------------------------ pairs
def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``b`` is ``a`` with one more letter: the letters agree up to a place, and behind it one further on."""
    front, back = a != b[:, :-1], a != b[:, 1:]
    until = np.where(front.any(1), front.argmax(1), a.shape[1])
    since = np.where(back.any(1), a.shape[1] - back[:, ::-1].argmax(1), 0)
    return since <= until


def near_in_box(words: list[str], kinds: np.ndarray, leaf: int = 32, pairs: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the words one edit apart, where the second is one of the box's own."""
    mine = np.flatnonzero(kinds == OWN)
    if not len(mine):
        return mine, mine
    size = len(words[mine[0]])
    code = codes([words[i] for i in mine], size)
    leaves: list[np.ndarray] = []
    tree = Tree.over(points(code), leaf, lambda _, own: leaves.append(own))
    out_a, out_b = [], []
    for asked, length, up, down, edit in ((kinds != SHORTER, size, 1, 1, one_replaced), (kinds == SHORTER, size - 1, 1, 0, one_inserted)):
        at = np.flatnonzero(asked)
        if not len(at):
            continue
        own_code = codes([words[i] for i in at], length)
        for k, some in tree.within(points(own_code), up, down):
            has = leaves[k]
            for a in range(0, len(some), step := max(1, pairs // len(has))):
                q, d = np.repeat(some[a:a + step], len(has)), np.tile(has, len(some[a:a + step]))
                ok = edit(own_code[q], code[d])
                q, d = at[q[ok]], mine[d[ok]]
                once = (kinds[q] != OWN) | (q < d)
                out_a.append(q[once])
                out_b.append(d[once])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (mine[:0], mine[:0])


def near_pairs(words: DataFrame, leaf: int = 1_000, sample_words: int = 60_000) -> DataFrame:
    """(word, other, other_n): both ways, every two words one edit apart.  ``words`` (word, n) is a written table of distinct words."""
    spark = words.sparkSession
    lengths = {r["size"]: r["k"] for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("k")).collect()}  # a row per length
    sample: dict[int, list[str]] = {}
    for r in smallest_hashes(words, F.xxhash64("word"), sample_words, "word").select("word").collect():  # at most sample_words
        sample.setdefault(len(r["word"]), []).append(r["word"])
    boxes = spark.sparkContext.broadcast(Boxes.fit(lengths, sample, leaf))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            for box, kind, some in boxes.value.deal(rows.column("word").to_pylist()):
                if len(some):
                    yield from rows.take(pa.array(some)).append_column("box", pa.array(np.full(len(some), box, np.int32))).append_column(
                        "kind", pa.array(np.full(len(some), kind, np.int8))).combine_chunks().to_batches()

        held, n = [], 0
        for batch in batches:  # trees are walked for many words at once
            held.append(batch)
            n += batch.num_rows
            if n >= 50_000:
                yield from _joined(dealt(held))
                held, n = [], 0
        if n:
            yield from _joined(dealt(held))

    def search(rows: pa.Table) -> pa.Table:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        a, b = near_in_box(words, rows.column("kind").to_numpy())
        word = pa.array(words, pa.string())
        one, two = word.take(pa.array(a)), word.take(pa.array(b))
        return pa.table({"word": pa.concat_arrays([one, two]), "other": pa.concat_arrays([two, one]), "other_n": np.concatenate([n[b], n[a]])})

    dealt = words.select("word", "n").mapInArrow(deal, "word string, n long, box int, kind byte")
    return dealt.groupBy("box").applyInArrow(search, "word string, other string, other_n long")


def _joined(parts: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += p.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# ------------------------------------------------------------------------------------------ forms
def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``: from a word, follow ``form`` to the last; ``forms`` is a written table.

    Each round doubles the steps that ``up`` stands for, so chains of c words take log2(c) rounds; counts at least
    double along a chain, so there are at most 6 rounds for counts under 2**63.
    """
    up = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("up"))
    while True:
        further = up.select(F.col("word").alias("at"), F.col("up").alias("further"))
        step = up.join(further, F.col("up") == F.col("at"), "left")
        up = materialise(step.select("word", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        if up.filter("moved").isEmpty():
            break
        up = up.drop("moved")
    last = up.select(F.col("word").alias("at"), F.col("up").alias("root"))
    return forms.join(last, F.col("word") == F.col("at"), "left").withColumn("root", F.coalesce("root", "word")).drop("at")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                      ratio: int = 2, leaf: int = 1_000, sample_words: int = 60_000) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    A word's form is its near word (one letter inserted, deleted or replaced) of largest count, the smallest in code-point order
    among equals, if its count is at least ``ratio`` (2 or more) times the word's; a count of exactly that is enough.
    Null, empty and letterless texts have no words; a null id counts as an empty one where ids matter (the dropped letters).
    Repeated rows count again; an empty table gives no rows; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: chains of forms have to end")
    small_batches(docs.sparkSession)
    words = materialise(word_counts(docs, id_col, text_col, min_length, min_count), "variant-words")
    near = near_pairs(words, leaf, sample_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    near = near.withColumnRenamed("word", "at")
    rows = words.join(near, F.col("word") == F.col("at"), "left")
    good = -F.col("best.minus") >= ratio * F.col("n")
    forms = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.other")).alias("form"),
                        F.when(good, -F.col("best.minus")).alias("form_n"))
    return with_roots(materialise(forms, "variant-forms"))
