"""Substring dedup by hashing units: lines, and the sentences within them.

A unit is a run of words up to a line break or a sentence end.  Normalised (A-Z lower-cased, blanks
made one), it has a 128-bit digest.  Of equal units in the corpus the earliest ranked occurrence
stays; runs of adjacent later occurrences of at least ``min_words`` words are removed, with
their offsets in the original text.  Units within lines are needed because a repeated passage
may begin and end inside a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches

END = np.zeros(256, bool)
END[[ord(c) for c in ".!?"]] = True


def split_units(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The units of all texts: text, unit (ordinal in the text), start, end (characters), words, hi, lo, again (the text has it before)."""
    w = tp.words(texts)
    n = len(w.start)
    if not n:
        empty = np.zeros(0, np.int64)
        return dict.fromkeys(("text", "unit", "start", "end", "words", "hi", "lo"), empty) | {"again": np.zeros(0, bool)}
    end = w.start + w.size
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    cut = np.ones(n, bool)
    cut[1:] = END[w.data[end[:-1] - 1]] | (lines[w.start[1:]] > lines[end[:-1]])
    at = np.flatnonzero(cut)
    to = np.concatenate([at[1:], [n]])
    place = (np.arange(n) - np.repeat(at, to - at)).astype(tp.U)
    h = tp.word_hashes(w)
    hi = np.add.reduceat(tp.scramble(h ^ tp.scramble(place + tp.K3)), at)
    lo = np.add.reduceat(tp.scramble((h + tp.K1) ^ tp.scramble(place * tp.K2 + tp.K1)), at)
    chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    text = w.text[at]
    first = np.searchsorted(text, np.arange(len(texts)))
    base = chars[w.text_at[text]]
    order = np.lexsort((np.arange(len(at)), lo, hi, text))
    same = (text[order][1:] == text[order][:-1]) & (hi[order][1:] == hi[order][:-1]) & (lo[order][1:] == lo[order][:-1])
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    return {"text": text, "unit": np.arange(len(at)) - first[text], "start": chars[w.start[at]] - base, "end": chars[end[to - 1]] - base,
            "words": to - at, "hi": hi.view(np.int64), "lo": lo.view(np.int64), "again": again}


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, unit, start, end, words, hi, lo, again) of every unit; ``row`` is a hash of the text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("text").to_pylist()
            for a, b in tp.parts(values):
                u = split_units(values[a:b])
                take = pa.array(u["text"] + a)
                cols = {"id": batch.column("id").take(take), "row": batch.column("row").take(take)}
                cols |= {k: pa.array(u[k], pa.int32()) for k in ("unit", "start", "end", "words")}
                cols |= {k: pa.array(u[k]) for k in ("hi", "lo", "again")}
                yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(cut, f"id {kind}, row long, unit int, start int, end int, words int, hi long, lo long, again boolean")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """One row per removed span: id, row, start, end (characters of the original text), n_words, kept_ids.

    Occurrences rank by id (null last), text hash and place.  ``kept_ids`` lists the documents whose earlier occurrences
    stay.  Rows with one id and one text are one document, so they give equal spans and neither removes the other.
    Null and wordless texts have no unit; an empty table gives no rows; other columns are ignored.

    Scale: the units are written once; their digests are grouped with map-side partial aggregation, and only digests
    that occur twice are joined back, from a written table, so AQE can split a line that a third of all rows have.
    """
    u = materialise(units(docs, id_col, text_col), "units")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    digests = u.filter(~F.col("again")).groupBy("hi", "lo").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    several = digests.filter(F.col("first") != F.col("last")).select("hi", "lo", "first.id", "first.row")
    several = several.withColumnsRenamed({"id": "kept_id", "row": "kept_row"})
    several = materialise(several, "unit-repeats")
    later = ~(F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_row") == F.col("row")))
    cols = ["id", "row", "unit", "start", "end", "words"]
    across = u.join(several, ["hi", "lo"]).filter(later).select(*cols, "kept_id")
    within = u.filter("again").select(*cols, F.col("id").alias("kept_id"))
    by_row = Window.partitionBy("id", "row").orderBy("unit")
    # one row per unit: a unit repeated within a text may be repeated across texts too, and rows may repeat
    removed = across.unionByName(within).groupBy(*cols).agg(F.min("kept_id").alias("kept_id"))
    runs = removed.withColumn("run", F.col("unit") - F.row_number().over(by_row))
    spans = runs.groupBy("id", "row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                                 F.sum("words").alias("n_words"), F.array_sort(F.collect_set("kept_id")).alias("kept_ids"))
    return spans.filter(F.col("n_words") >= min_words).select(F.col("id").alias(id_col), "row", "start", "end", "n_words", "kept_ids")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """``docs`` with the repeated spans taken out of the text, and ``removed``: the spans' offsets in the original text
    (a column of that name is replaced)."""
    spans = repeated_spans(docs, id_col, text_col, min_words)
    per_row = materialise(spans.groupBy(F.col(id_col).alias("__id"), F.col("row").alias("__row"))
                          .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cut")), "unit-spans")
    joined = docs.join(per_row, docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__row")), "left")
    begins = F.concat(F.array(F.lit(0)), F.col("__cut")["end"])
    ends = F.concat(F.col("__cut")["start"], F.array(F.length(text_col)))
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col(text_col), a + 1, b - a))
    text = F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return joined.withColumns({"removed": F.coalesce("__cut", none), text_col: text}).drop("__id", "__row", "__cut")
