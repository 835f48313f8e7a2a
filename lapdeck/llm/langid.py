"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text.  A document is parsed into the longest
pieces that occur in that text (each piece is followed greedily from the automaton's root), and
the language that needs the fewest pieces, normalised by the automaton's text size, wins.

Documents are parsed in lockstep: a part of a document's characters is one row of a matrix, and one
numpy step moves every row by a character through a transition table in which a missing transition leads on from the root and
carries the mark of a new piece.  A document is cut into rows of ``ROW`` characters; the pieces of
all its rows add up, and a cut costs every language at most one piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches

ROW = 1024
LETTERS = 94  # alphabet: the most frequent characters of the labelled text; all others are one more symbol


def suffix_automaton(text: list[int], symbols: int) -> np.ndarray:
    """Transitions [state, symbol] of the suffix automaton of ``text``; state 0 is the root, -1 is none."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.full((len(step), symbols), -1, np.int32)
    for s, moves in enumerate(step):
        if moves:
            table[s, list(moves)] = list(moves.values())
    return table


class Parser:
    """Automata of all languages over one alphabet."""

    NEW = np.int32(1 << 30)

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        seen = pd.Series(list("".join(texts[k].lower() for k in self.languages))).value_counts()
        common = sorted(seen.index, key=lambda c: (-seen[c], c))[:LETTERS]
        self.symbols = len(common) + 1
        self.code = np.full(0x10000, len(common), np.uint8)
        for i, c in enumerate(common):
            if ord(c) < 0x10000:
                self.code[ord(c)] = i
        self.tables, self.log_size = [], []
        for name in self.languages:
            data = self.encode([texts[name].lower()])[0]
            table = suffix_automaton(data.tolist(), self.symbols)
            root = np.where(table[0] >= 0, table[0], 0)
            # offsets instead of states; a missing move goes on from the root and marks a new piece
            full = np.where(table >= 0, table * self.symbols, (root * self.symbols)[None, :] | self.NEW)
            self.tables.append(np.ascontiguousarray(full.astype(np.int32).ravel()))
            self.log_size.append(math.log2(len(data) + 2))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all texts, where each begins and the end)."""
        raw = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        chars = np.concatenate(raw) if raw else np.zeros(0, np.uint32)
        return self.code[np.minimum(chars, 0xFFFF)], at

    def pieces(self, texts: list[str]) -> np.ndarray:
        """Pieces by text and language."""
        data, at = self.encode([t.lower() for t in texts])
        size = np.diff(at)
        rows = -(-size // ROW)
        owner = np.repeat(np.arange(len(texts)), rows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(rows) - rows, rows)
        start = at[owner] + nth * ROW
        length = np.minimum(ROW, size[owner] - nth * ROW)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(ROW), "left")  # rows longer than j come first
        data = np.concatenate([data, np.zeros(1, np.uint8)])
        out = np.zeros((len(texts), len(self.languages)))
        state = np.zeros((len(self.languages), len(owner)), np.int32)
        count = np.ones_like(state)
        for j in range(ROW):
            n = active[j]
            if n == 0:
                break
            c = data[start[:n] + j].astype(np.int32)
            for k, table in enumerate(self.tables):
                s = table[(state[k, :n] & (self.NEW - 1)) + c]
                state[k, :n] = s
                count[k, :n] += s >> 30
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, count[k], len(texts))
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score by text; ``und`` and 0 for null or without a letter."""
        real = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages or not real:
            return names, scores
        cost = self.pieces([texts[i] for i in real]) * np.array(self.log_size)
        for i, row in zip(real, cost, strict=True):
            order = np.argsort(row, kind="stable")
            names[i] = self.languages[order[0]]
            scores[i] = float(1 - row[order[0]] / (row[order[0]] + row[order[1]])) if len(order) > 1 else 1.0
        return names, scores


_PARSERS: dict[int, Parser] = {}


def sample_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 chars: int = 60_000, per_language: int = 200, seed: int = 3) -> dict[str, str]:
    """At most ``chars`` characters of labelled text per language: whole documents, those of smallest id hash first,
    of at most ``per_language`` documents.  A document that does not fit is passed over."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("at"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"))
    fits = rows.filter("lang is not null and text is not null").filter(F.length("text").between(1, chars))
    order = Window.partitionBy("lang").orderBy("at", "id")
    first = fits.select("lang", "at", "id").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language)
    edge = materialise(first.groupBy("lang").agg(F.max("at").alias("edge")), "langid-edge")
    chosen = fits.join(edge, "lang").filter(F.col("at") <= F.col("edge")).drop("edge")
    rows = chosen.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language)
    used = F.sum(F.length("text") + 1).over(Window.partitionBy("lang").orderBy("at", "id", "k"))
    picked = rows.withColumn("used", used).filter(F.col("used") <= chars).select("lang", "at", "id", "k", "text")
    out: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["k"])):  # bounded: chars per language
        out.setdefault(r["lang"], []).append(r["text"])
    return {k: "\n".join(v) for k, v in out.items()}


def predict(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row; score is 1 - fewest / (fewest + second fewest) normalised pieces, 1 with one language.

    ``und`` with score 0 for null texts and texts without a letter, and for all if no labelled text was given.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(texts)  # at most ``chars`` characters a language

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = hash(tuple(sorted(shared.value.items())))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(shared.value)
        for batch in batches:
            values = [t if isinstance(t, str) else None for t in batch["text"]]
            for a, b in tp.parts(values, 4_000_000):
                lang, score = _PARSERS[key].judge(values[a:b])
                yield pd.DataFrame({"id": batch["id"].iloc[a:b].to_numpy(), "lang_pred": lang, "score": score})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(parse, "id string, lang_pred string, score double")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
             held: int = 1, **sample) -> DataFrame:
    """Learn from labelled documents outside the held-out fold, and predict every document.

    The fold is crc32(id as text) modulo ``folds``; a null id is in no fold and is not learnt from.  Returns
    id, held_out, lang_pred, score.  Repeated rows are predicted alike; ties go to the first language
    in code point order; an empty table gives no rows; other columns are ignored.
    """
    fold = F.crc32(F.col(id_col).cast("string")) % folds
    texts = sample_texts(docs.filter(fold != held), id_col, text_col, lang_col, **sample)
    out = predict(docs, texts, id_col, text_col)
    return out.select(id_col, F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
