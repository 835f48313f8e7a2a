"""Quality rules: per-document counts, and lines that many documents of a host share.

1. One pass over every whole text counts its words, symbols, repeated lines and repeated 3-word windows, and hashes its
   normalised lines (A-Z lower-cased, digits as 0, blanks between words as one).  The facts are written once, with row numbers.
2. For each host and line the *distinct texts* that hold it are counted (copies of one text are one document here, so a
   text that was merely taken many times does not lose all its lines).  First (host, line, text) is made distinct, then
   counted per (host, line) with a map-side sum, so that a line in a third of all documents is no hot task.
3. A line is common when its texts are at least ``min_docs`` and more than ``max_share`` of the host's texts.  Common lines go;
   a document is rejected when it fails the base rules, or when too few of its words are left.

Line identity is a 64-bit hash of the line's words within its host.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
PLAIN = np.arange(256, dtype=np.uint8)  # the byte by which a line is compared
PLAIN[65:91] += 32
PLAIN[48:58] = 48
PART = 500_000
BASE = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """``min_words``, ``max_repeat``: a text with fewer words, or a larger share of words in repeated 3-word windows, fails the base
    rules.  ``min_docs``, ``max_share``: see the module.  ``min_left``, ``min_left_share``: words, and share of its words, that a
    document must keep without its common lines."""

    min_words: int = 50
    max_repeat: float = 0.5
    min_docs: int = 10
    max_share: float = 0.05
    min_left: int = 20
    min_left_share: float = 0.5


def _line_of(w: tp.Words) -> tuple[np.ndarray, np.ndarray]:
    """Where each line ends (texts end lines too), and each word's line."""
    end = np.flatnonzero(w.data[:w.text_at[-1]] == 10)
    return end, np.searchsorted(end, w.start)


def line_hashes(w: tp.Words, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of each line that has a word: a hash of its normalised words in order."""
    if not len(line):
        return line, np.zeros(0, tp.U)
    h = tp.word_hashes(tp.Words(PLAIN[w.data], w.text_at, w.start, w.size, w.text))
    at = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    place = np.arange(len(line)) - np.repeat(at, np.diff(np.append(at, len(line))))
    return line[at], tp.scramble(np.add.reduceat(tp.scramble(h ^ (place.astype(tp.U) * tp.K2)), at))


def _again(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values ``h`` in texts: whether the text has it more than once, and whether it has it earlier."""
    order = np.lexsort((h, text))  # stable: equal values stay in text order
    same = (text[order][1:] == text[order][:-1]) & (h[order][1:] == h[order][:-1])
    twice, earlier = np.zeros(len(h), bool), np.zeros(len(h), bool)
    earlier[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, earlier


def base_counts(texts: list[str | None]) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Counts by text, and (text, hash, words) of its distinct normalised lines, by text."""
    w, n = tp.words(texts, lower=False), len(texts)
    data = w.data[:w.text_at[-1]]

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.view(np.uint8), w.text_at[:-1], dtype=np.int64) if n else np.zeros(0, np.int64)

    h = tp.word_hashes(w)
    repeat = np.zeros(len(h), bool)
    if len(h) >= 3:
        whole = np.flatnonzero(w.text[2:] == w.text[:-2])
        twice, _ = _again(w.text[whole], tp.scramble(h[whole] + tp.K1 * h[whole + 1]) + tp.K2 * h[whole + 2])
        for j in range(3):
            repeat[whole[twice] + j] = True
    end, line = _line_of(w)
    seen, norm = line_hashes(w, line)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    whole_lines = tp.Words(w.data, w.text_at, start[seen], end[seen] - start[seen], np.searchsorted(w.text_at, start[seen], "right") - 1)
    text = whole_lines.text
    _, dup = _again(text, tp.word_hashes(whole_lines))
    in_line = np.bincount(np.searchsorted(seen, line), minlength=len(seen)) if len(seen) else np.zeros(0, int)
    counts = {"n_words": np.bincount(w.text, minlength=n), "word_chars": per_text(~tp.BLANK[data] & ((data & 0xC0) != 0x80)),
              "n_symbols": per_text(SYMBOLS[data]), "n_dup_lines": np.bincount(text[dup], minlength=n),
              "n_repeat_words": np.bincount(w.text[repeat], minlength=n)}
    order = np.lexsort((norm, text))
    text, norm, in_line = text[order], norm[order], in_line[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (norm[1:] != norm[:-1])]) if len(text) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return counts, (text[at], norm[at], np.add.reduceat(in_line, at) if len(at) else in_line)


def line_facts(docs: DataFrame, id_col: str, text_col: str, host: Column) -> DataFrame:
    """One row per document: id, host, digest of the text, n_words and ``BASE``, and its distinct lines' hashes and words."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ("n_words", *BASE)
    schema = f"id {kind}, host string, digest long, {', '.join(f'{c} long' for c in names)}, line array<long>, words array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in tp.parts(texts, PART):
                counts, (text, norm, words) = base_counts(texts[a:b])
                cuts = pa.array(np.searchsorted(text, np.arange(b - a + 1)), pa.int32())
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_pydict({
                    "id": own.column("id"), "host": own.column("host"), "digest": own.column("digest"),
                    **{c: pa.array(counts[c], pa.int64()) for c in names},
                    "line": pa.ListArray.from_arrays(cuts, pa.array(norm.view(np.int64))),
                    "words": pa.ListArray.from_arrays(cuts, pa.array(words, pa.int32()))})

    rows = docs.select(F.col(id_col).alias("id"), host.cast("string").alias("host"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, schema)


def common_lines(facts: DataFrame, limits: Limits) -> DataFrame:
    """(host, line, n_docs) of the lines above the limits; ``facts`` is a written table.  A null host is a host."""
    held = facts.select("host", "digest", F.explode("line").alias("line"))
    often = held.groupBy("host", "line", "digest").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("one").alias("n_docs"))
    often = materialise(often.filter(F.col("n_docs") >= limits.min_docs), "line-counts")
    hosts = facts.groupBy("host", "digest").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("all_docs"))
    hosts = materialise(hosts.withColumnRenamed("host", "of"), "line-hosts")
    above = often.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    return above.filter(F.col("n_docs") > limits.max_share * F.col("all_docs")).select("host", "line", "n_docs")


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits, rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """The verdicts, and (row, line) of the lines that go, both by row number of the written facts."""
    small_batches(docs.sparkSession)
    facts = line_facts(docs, id_col, text_col, F.col(host_col)).withColumn("row", F.monotonically_increasing_id())
    facts = materialise(facts, "line-facts")
    common = materialise(common_lines(facts, limits).select(F.col("host").alias("of"), F.col("line").alias("bad")), "line-common")
    held = facts.select("row", "host", F.explode(F.arrays_zip("line", "words")).alias("z")).select("row", "host", "z.line", "z.words")
    # two plain scans: AQE splits the partition of a line that very many documents hold
    gone = held.join(common, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("bad"))).select("row", "line", "words")
    lost = gone.groupBy("row").agg(F.count("*").alias("n"), F.sum("words").alias("w")).withColumnRenamed("row", "at")
    left = F.col("n_words") - F.col("removed_words")
    base = (F.col("n_words") < limits.min_words) | (F.col("n_repeat_words") > limits.max_repeat * F.col("n_words"))
    out = facts.join(materialise(lost, "line-lost"), F.col("row") == F.col("at"), "left").withColumns({
        "removed_lines": F.coalesce("n", F.lit(0)).cast("long"), "removed_words": F.coalesce("w", F.lit(0)).cast("long")})
    out = out.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & (left >= limits.min_left) & (left >= limits.min_left_share * F.col("n_words")))
    return out, gone


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_lines (distinct common lines),
    removed_words, base_failed, kept.

    Null, empty and wordless texts have zeros everywhere and fail the base rules.  Documents without a host share the null host.
    Repeated rows are judged alike and count as one text.  Exactly ``min_docs`` texts are enough, exactly ``max_share`` of
    them is not; shares equal to the other limits pass.  An empty table gives no rows; other columns are ignored.
    """
    out, _ = _judged(docs, id_col, text_col, host_col, limits)
    return out.select(F.col("id").alias(id_col), "n_words", *BASE, "removed_lines", "removed_words", "base_failed", "kept")


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The kept documents with their own columns, their texts without common lines (and without the line breaks behind them).

    Edge cases as in ``judge``; a text without a common line stays byte for byte.
    """
    small_batches(docs.sparkSession)
    own, schema = docs.columns, docs.schema
    numbered = materialise(docs.select(F.struct(*[F.col(c) for c in own]).alias("doc"), F.monotonically_increasing_id().alias("no")), "line-docs")
    verdict, gone = _judged(numbered.select("no", F.col(f"doc.{text_col}").alias("text"), F.col(f"doc.{host_col}").alias("host")),
                            "no", "text", "host", limits)
    bad = gone.groupBy("row").agg(F.collect_list("line").alias("bad")).withColumnRenamed("row", "at")  # at most a text's own lines
    kept = verdict.filter("kept").select("id", "row").join(bad, F.col("row") == F.col("at"), "left").select("id", "bad")
    both = numbered.join(materialise(kept, "line-kept"), F.col("no") == F.col("id"))

    @F.pandas_udf("string")
    def without(texts, bads):
        return texts.combine(bads, _without)

    text = F.when(F.col("bad").isNull(), F.col(f"doc.{text_col}")).otherwise(without(F.col(f"doc.{text_col}"), F.col("bad")))
    return both.select(*[(text if c == text_col else F.col(f"doc.{c}")).alias(c) for c in own]).to(schema)


def _without(text: str | None, bad: np.ndarray | None) -> str | None:
    if text is None or bad is None or not len(bad):
        return text
    w = tp.words([text], lower=False)
    line, norm = line_hashes(w, _line_of(w)[1])
    out = set(line[np.isin(norm.view(np.int64), np.asarray(bad, np.int64))].tolist())
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)
