"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Candidates are runs of characters like keys, whatever is assigned to a secret's name, and passwords in URLs.

Features of a candidate: its length and characters, character transitions (against a bigram
model of the corpus's own words), dictionary coverage, its path (the document's source) and its
neighbouring words.  The forest is trained from labelled findings.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches, smallest_hashes

#: A run of at least 12 such characters with a digit or in mixed case (a lower-case letter, and a capital that is not the first
#: character), or of 16 capitals or more.  Matching starts at the edge of a run of such characters only, so long texts stay linear.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/.\-])(?:(?:(?=[A-Za-z_+/.\-]*[0-9])|(?=[A-Za-z_+/.\-]+[A-Z])(?=[A-Z_+/.\-]*[a-z]))[A-Za-z0-9_+/.\-]{12,}"
                       r"|[A-Z]{16,}(?![A-Za-z0-9_+/.\-]))")
SECRET_NAME = r"(?:password|passwd|pwd|secret|token|api[_\-]?key|access[_\-]?key|auth)[\"']?\s*(?::=|=>|[:=])\s*"
#: What is assigned to a secret's name, of any length: all between quotes on one line, or else up to a blank, a quote, < or >,
#: or the next assignment (&, comma or semicolon and a name).
ASSIGNED = re.compile(rf"(?i:{SECRET_NAME})(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|[\"']?((?:(?![&,;][\w.\-]+[\"']?[=:])[^\s\"'<>])+))")
#: The password of a URL's user info; one with a slash is no port number and a path.
USERINFO = re.compile(r"(?<=[A-Za-z0-9+.\-])://[^\s/:@\"'<>]*:([^\s/?#\"'<>]+(?=@)|(?!\d+[/?#])(?:(?!://)[^\s\"'<>])+?(?=@[\w.\-]))")
WORD = re.compile(r"[^\W\d_]+")
NEAR, HASHED = 48, 24
#: Words of a path that say that its strings are samples.
SAMPLE_PATHS = ("test", "example", "sample", "fixture", "mock", "doc")
BASE = ("length", "digits", "uppers", "lowers", "symbols", "entropy", "classes", "changes", "hex", "transition", "coverage", "longest_word",
        "dots", "slashes", "quoted", "assigned", "after_at", "path_depth", "path_sample")
FEATURES = BASE + tuple(f"near_{i}" for i in range(HASHED)) + tuple(f"path_{i}" for i in range(8))

# Published formats of credentials, and of strings that are none.
KNOWN_SECRET = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9\-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$"
SECRET_NAMES = rf"(?i){SECRET_NAME}[\"']?$"
IN_URL = r"://[^\s/:@]*:$"
KNOWN_PLAIN = (r"^[0-9.]+$|^[0-9+\-]+$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
               r"|^v?[0-9]+(\.[0-9]+)+|^[a-z0-9.\-]+\.(com|org|net|io|html?|js|css|png|jpe?g)$"
               r"|^[A-Z]?[a-z]{2,}([A-Z][a-z]{2,})+$|^[A-Z]?[a-z]+([_+/.\-]+[A-Z]?[a-z]+)+$")  # words joined by capitals or signs


def _bucket(word: str, n: int) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=4).digest(), "little") % n


def corpus_dictionary(docs: DataFrame, text_col: str = "text", size: int = 5_000) -> dict[str, int]:
    """The most frequent words of 3 to 14 lower-case letters over all texts, with counts: all words above the count at which there
    would be more than ``size``, so never more than that reach the driver."""
    word = F.explode(F.split(F.lower(F.col(text_col)), r"[\x20\x09-\x0D]+")).alias("word")
    plain = docs.select(word).filter(F.col("word").rlike(r"^\p{Ll}{3,14}$"))
    counts = materialise(plain.groupBy("word").agg(F.count("*").alias("n")), "secret-words")
    upto = F.sum("words").over(Window.orderBy(F.desc("n")))  # one row per count, not per word
    levels = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("upto", upto)
    least = levels.filter(F.col("upto") <= size).agg(F.min("n")).first()[0]
    return {r["word"]: r["n"] for r in counts.filter(F.col("n") >= (least or 0)).collect()} if least else {}


class Lexicon:
    """Dictionary and bigram model, for the features of a candidate."""

    def __init__(self, words: dict[str, int]):
        self.words = set(words)
        pairs: Counter[str] = Counter()
        for w, n in words.items():
            for a, b in zip(f" {w}", f"{w} ", strict=True):
                pairs[a + b] += n
        firsts: Counter[str] = Counter()
        for p, n in pairs.items():
            firsts[p[0]] += n
        self.log = {p: math.log((n + 1) / (firsts[p[0]] + 40)) for p, n in pairs.items()}
        self.rare = math.log(1 / 400)

    def features(self, value: str, before: str, after: str, path: str) -> list[float]:
        n = len(value)
        counts = Counter(value)
        kinds = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value)
        low = value.lower()
        steps = [self.log.get(low[i:i + 2], self.rare) for i in range(n - 1)]
        runs = WORD.findall(low)
        known = [r for r in runs if r in self.words]
        near = [0.0] * HASHED
        for w in [*WORD.findall(before)[-2:], *WORD.findall(after)[:1]]:
            near[_bucket(w.lower(), HASHED)] += 1.0
        where = [0.0] * 8
        where[_bucket(path, 8)] = 1.0
        left = before.rstrip()[-1:]
        return [
            math.log1p(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, kinds.count("s") / n,
            -sum(c / n * math.log2(c / n) for c in counts.values()), float(len(set(kinds))),
            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1), float(all(c in "0123456789abcdef" for c in low)),
            sum(steps) / max(1, len(steps)), sum(map(len, known)) / n, float(max(map(len, runs), default=0)),
            float(value.count(".")), float(value.count("/")), float(left in "\"'" and left != ""), float(left == "=" or before.rstrip(" \"'")[-1:] in ("=", ":")),
            float(left == "@"), float(path.count("/")), float(any(s in path.lower() for s in SAMPLE_PATHS)), *near, *where]


def spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates of a text, in order; those that overlap are one."""
    found = [m.span() for m in CANDIDATE.finditer(text)] + [m.span(1) for m in USERINFO.finditer(text)]
    for m in ASSIGNED.finditer(text):
        a, b = m.span(m.lastindex)
        if m.lastindex == 3:  # a sentence's end and a bracket opened before it are not the value's
            count = {c: text.count(c, a, b) for c in "()[]{}"}
            while b - a > 1 and ((c := text[b - 1]) in ".,;" or c in ")]}" and count[c] > count["([{"[")]}".index(c)]]):
                count[c] = count.get(c, 0) - 1
                b -= 1
        found.append((a, b))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def candidates(docs: DataFrame, words: dict[str, int], id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, row, start, end, value, before, after, features) of every candidate; offsets are in characters, ``row`` is a hash of the text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text"),
                       F.col(path_col).cast("string").alias("path"))
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(words)  # at most ``size`` words

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            at, out = [], []
            paths = batch.column("path").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                for a, b in spans(text or ""):
                    value = text[a:b]
                    before, after = text[max(0, a - NEAR):a], text[b:b + NEAR]
                    at.append(i)
                    out.append((a, b, value, before, after, lexicon.features(value, before, after, paths[i] or "")))
            if at:
                a, b, value, before, after, features = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").take(pa.array(at)), "row": batch.column("row").take(pa.array(at)), "start": pa.array(a, pa.int32()),
                    "end": pa.array(b, pa.int32()), "value": pa.array(value), "before": pa.array(before), "after": pa.array(after),
                    "features": pa.array(features, pa.list_(pa.float64()))})

    return rows.mapInArrow(find, f"id {kind}, row long, start int, end int, value string, before string, after string, features array<double>")


def rule_labels(value: Column, before: Column, after: Column | None = None) -> Column:
    """Labelled findings where no reviewer's labels are given: 1 for published credential formats, for values assigned to a secret's
    name (a word of letters after a colon and a blank may be prose and has no label) and for the password before a URL's host, 0 for
    the formats of addresses, numbers, versions, file names and joined words, null for all else."""
    named = before.rlike(SECRET_NAMES)
    prose = before.rlike(r":\s+$") & value.rlike(r"^\p{L}+$")
    url = before.rlike(IN_URL) & after.startswith("@") if after is not None else F.lit(False)
    return (F.when(value.rlike(KNOWN_SECRET) | (named & ~prose) | url, 1.0).when(~named & value.rlike(KNOWN_PLAIN), 0.0))


def train(found: DataFrame, label: Column, sample_rows: int = 5_000, trees: int = 30, depth: int = 6, seed: int = 11) -> RandomForestClassificationModel | float:
    """Fit the forest on at most ``sample_rows`` labelled candidates of either class (smallest hash first); the constant share of
    secrets if there is one class only, 1 (nothing is removed) without labels."""
    labelled = found.withColumn("label", label).filter("label is not null")
    at = F.xxhash64(F.lit(seed), "row", "start")
    each = [smallest_hashes(labelled.filter(F.col("label") == v), at, sample_rows, "row", "start").select("label", "features") for v in (0.0, 1.0)]
    sample = materialise(each[0].unionByName(each[1]).coalesce(1), "secret-sample")
    classes = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(classes) < 2:
        return max(classes, default=1.0)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
    return model.fit(sample.select("label", array_to_vector("features").alias("features")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", label: Column | None = None,
         threshold: float = 0.5, dictionary_size: int = 5_000, **fit) -> DataFrame:
    """One row per candidate: id, row, start, end, digest (SHA-256 of the value), score, is_secret.

    ``label`` is a column over ``candidates`` (1, 0 or null); by default ``rule_labels``.  Null and empty texts have no candidate, null ids
    and paths are kept and empty; repeated rows give repeated findings; an empty table gives no rows; other columns are
    ignored.  The candidates, few against the texts, are written once; the texts are read for the dictionary and the candidates only.
    """
    words = corpus_dictionary(docs, text_col, dictionary_size)
    found = materialise(candidates(docs, words, id_col, text_col, path_col), "secret-candidates")
    model = train(found, rule_labels(F.col("value"), F.col("before"), F.col("after")) if label is None else label, **fit)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        vectors = found.withColumn("features", array_to_vector("features"))
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(id_col), "row", "start", "end", F.sha2("value", 256).alias("digest"), F.round("score", 9).alias("score"),
                         (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", **how) -> DataFrame:
    """``docs`` with every finding judged a secret replaced by ``mark`` in the text."""
    found = scan(docs, id_col, text_col, **how).filter("is_secret")
    per_row = materialise(found.groupBy(F.col(id_col).alias("__id"), F.col("row").alias("__row"))
                          .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__cut")), "secret-spans")
    joined = docs.join(per_row, docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__row")), "left")
    begins, ends = F.concat(F.array(F.lit(0)), F.col("__cut")["end"]), F.concat(F.col("__cut")["start"], F.array(F.length(text_col)))
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col(text_col), a + 1, b - a))
    text = F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(F.array_join(kept, mark))
    return joined.withColumn(text_col, text).drop("__id", "__row", "__cut")
