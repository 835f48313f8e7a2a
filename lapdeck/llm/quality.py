"""Quality classifier from weak labels: heuristic labellers, EM over their votes, hashed linear scorer.

1. Overlapping labellers look at one signal of a text each and vote 1 (good), 0 (bad) or nothing.
2. Votes are discrete, so a corpus has at most ``3 ** labellers`` vote patterns: Spark counts the
   patterns over all documents and EM (two latent classes, each labeller with its own vote
   probabilities per class) runs exactly on that bounded table.
3. The posteriors of a bounded sample of documents train a logistic regression on hashed byte
   trigrams and hashed word shapes; it scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches, smallest_hashes

#: By signal: a value in the first range votes good, one in the second votes bad, others abstain.
VOTES = {
    "caps": (None, (0.5, 1.0)),                 # share of words of 2 or more letters without a lower-case one
    "lower": ((0.85, 1.0), (0.0, 0.5)),         # share of lower-case among the letters
    "symbols": (None, (0.08, 1.0)),             # share of bytes that are neither letters, digits nor usual punctuation
    "plain": ((0.9, 1.0), (0.0, 0.6)),          # share of words with letters and without such bytes
    "bare": (None, (0.12, 1.0)),                # share of words without any letter or digit
    "repeats": (None, (0.12, 1.0)),             # share of words that equal the word before
    "runs": ((0.0, 0.02), (0.10, 1.0)),         # share of words that equal the two words before
    "sentences": ((0.02, 0.4), (0.0, 0.003)),   # share of words that end a sentence
    "lines": (None, (0.5, 1.0)),                # share of lines that repeat a line before
    "length": ((30.0, 1e12), (0.0, 0.0)),       # words
}
SIGNALS = tuple(VOTES)
#: Prior share of the votes 1, 0 and none of a labeller, on good and on bad texts.
PRIOR = ((0.60, 0.002, 0.398), (0.40, 0.30, 0.30))
#: Words and bytes by which a text is lengthened before shares are taken, so that a few words say little.
FEW_WORDS, FEW_BYTES = 8, 40
SHAPES, DIM = 128, 2048
UPPER, LOWER, DIGIT, HIGH = (np.zeros(256, bool) for _ in range(4))
UPPER[65:91], LOWER[97:123], DIGIT[48:58], HIGH[128:] = True, True, True, True
PUNCT = np.zeros(256, bool)
PUNCT[[ord(c) for c in ".,;:!?'\"()-/"]] = True
END = np.zeros(256, bool)
END[[ord(c) for c in ".!?"]] = True
SYMBOL = ~(UPPER | LOWER | DIGIT | HIGH | PUNCT | tp.BLANK)
# In UTF-8 the Latin-1 capitals are C3 80 to C3 9E, their small letters C3 9F to C3 BF.
LATIN = 0xC3
#: Characters of texts, and bytes of trigrams, that are worked on at once: a character costs up to some 100 bytes meanwhile.
PART, BLOCK = 500_000, 1 << 18


class _Facts:
    """Per-word and per-text facts of one part of a column of texts."""

    def __init__(self, texts: list[str | None]):
        w = self.w = tp.words(texts, lower=False)
        d, n = w.data, len(texts)
        last = w.start + w.size - 1
        after_latin = np.zeros(len(d), bool)
        after_latin[1:] = d[:-1] == LATIN
        capital = after_latin & (d < 0x9F)
        bounds = np.stack([w.start, last + 1], 1).ravel()  # the data end in zero bytes, so every bound is inside

        def count(mask: np.ndarray) -> np.ndarray:
            """Bytes of the mask in each word."""
            return np.add.reduceat(mask.view(np.uint8), bounds, dtype=np.int32)[::2] if len(bounds) else np.zeros(0, np.int32)

        up = count(UPPER[d] | capital)
        low = count(LOWER[d] | HIGH[d] & ~capital & (d != LATIN))
        odd, dig = count(SYMBOL[d]), count(DIGIT[d])
        h = tp.word_hashes(w)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (w.text[1:] == w.text[:-1])
        run = same.copy()
        run[1:] &= same[:-1]
        self.shape = ((up > 0) | (low > 0) << 1 | (dig > 0) << 2 | (odd > 0) << 3 | same << 4 | (up > 1) << 5
                      | (END[d[last]]).astype(int) << 6) if len(h) else np.zeros(0, int)
        first = w.first
        self.n = np.diff(first)
        total = np.maximum(self.n, 1)

        def per_text(x: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(x)])
            return (c[first[1:]] - c[first[:-1]]) / total

        size = per_text(w.size) * total
        letters = np.maximum(per_text(up + low), 1e-9)
        self.signals = {
            "caps": per_text((up > 1) & (low == 0)), "lower": per_text(low) / letters,
            "symbols": per_text(odd) * total / np.maximum(size, 1), "plain": per_text((up + low > 0) & (odd == 0)),
            "bare": per_text((up + low + dig) == 0), "repeats": per_text(same), "runs": per_text(run),
            "sentences": per_text(END[d[last]]), "lines": np.array([_repeated_lines(t) for t in texts]) if n else np.zeros(0),
            "length": self.n.astype(float)}

    def votes(self) -> list[str]:
        """By text, one character per labeller: 1, 0 or - for none."""
        out = np.full((len(self.n), len(SIGNALS)), "-")
        for j, name in enumerate(SIGNALS):
            x = self.signals[name]
            for vote, span in zip("10", VOTES[name], strict=True):
                if span:
                    seen = (name == "length") | (self.n >= (1 if vote == "1" else FEW_WORDS))
                    out[seen & (x >= span[0]) & (x <= span[1]), j] = vote
        return ["".join(v) for v in out]

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, feature, value) of word shapes and byte trigrams, each a share of its text's words or trigrams, in blocks."""
        w = self.w
        yield w.text, self.shape, 4.0 / (self.n + FEW_WORDS)[w.text]
        share = 4.0 / (np.diff(w.text_at) + FEW_BYTES)
        for a in range(0, w.text_at[-1], BLOCK):
            d = w.data[a:min(a + BLOCK + 2, w.text_at[-1])].astype(np.uint32)
            gram = (tp.scramble((d[:-2] << 16 | d[1:-1] << 8 | d[2:]).astype(tp.U)) % tp.U(DIM - SHAPES)).astype(np.int32)
            at = np.searchsorted(w.text_at, np.arange(a, a + len(gram)), "right") - 1
            inside = np.arange(a + 2, a + 2 + len(gram)) < w.text_at[at + 1] - 1  # a text's score depends on no other text
            yield at[inside], gram[inside] + SHAPES, share[at[inside]]


def _repeated_lines(text: str | None) -> float:
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def _each(texts: pd.Series) -> Iterator[tuple[int, _Facts]]:
    values = [t if isinstance(t, str) else None for t in texts]
    for a, b in tp.parts(values, PART):
        yield b - a, _Facts(values[a:b])


def vote_column(text: Column) -> Column:
    """The labellers' votes on a text, as one string."""

    @F.pandas_udf("string")
    def votes(texts: pd.Series) -> pd.Series:
        return pd.Series([v for _, f in _each(texts) for v in f.votes()], dtype=object)

    return votes(text)


def _features(text: Column, posterior: dict[str, float]) -> Column:
    """A text's features and the posterior of its votes."""

    @F.pandas_udf("x array<float>, p double")
    def features(texts: pd.Series) -> pd.DataFrame:
        rows, p = [], []
        for n, f in _each(texts):
            x = np.zeros(n * DIM)
            for t, k, v in f.features():
                np.add.at(x, t * DIM + k, v)
            rows.extend(x.astype(np.float32).reshape(n, DIM))
            p += [posterior.get(v) for v in f.votes()]
        return pd.DataFrame({"x": pd.Series(rows, dtype=object), "p": pd.Series(p, dtype=float)})

    return features(text)


def fit_labellers(patterns: dict[str, int], rounds: int = 200, trust: float = 0.1) -> dict[str, float]:
    """EM on vote patterns and their counts; the posterior of ``good`` by pattern.

    Starts from: bad if any labeller says so.  Each labeller has a probability of each vote (none
    included) in each class.  ``PRIOR`` says that labellers seldom call a good text bad, and
    that each of them sees only some kinds of bad text; it counts as ``trust`` of all documents.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    onehot = np.array([[[c == v for v in "10-"] for c in k] for k in keys], float)  # pattern, labeller, vote
    good = np.array([0.05 if "0" in k else 0.95 for k in keys])
    for _ in range(rounds):
        logs = []
        for p, prior in zip((good, 1 - good), PRIOR, strict=True):
            c = np.einsum("p,plv->lv", n * p, onehot) + (1.0 + trust * n.sum()) * np.array(prior)
            logs.append(np.log((n * p).sum() + 1.0) + np.einsum("plv,lv->p", onehot, np.log(c / c.sum(1, keepdims=True))))
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return dict(zip(keys, map(float, good), strict=True))


class Scorer:
    """Posterior by vote pattern, and the hashed linear model.  ``judge`` gives (score, posterior, votes) of a text."""

    def __init__(self, posterior: dict[str, float], weights: np.ndarray, bias: float):
        self.posterior, self.weights, self.bias = posterior, weights, bias

    def judge(self, text: Column) -> Column:
        posterior, weights, bias = self.posterior, self.weights, self.bias

        @F.pandas_udf("score double, posterior double, votes string")
        def judge(texts: pd.Series) -> pd.DataFrame:
            out = []
            for n, f in _each(texts):
                z = np.zeros(n)
                for t, k, v in f.features():
                    z += np.bincount(t, weights[k] * v, n)
                score = np.where(f.n > 0, 1 / (1 + np.exp(-np.clip(z + bias, -50, 50))), 0.0)
                votes = f.votes()
                out.append(pd.DataFrame({"score": score, "posterior": [posterior.get(x, 0.0) for x in votes], "votes": votes}))
            return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"score": [], "posterior": [], "votes": []})

        return judge(text)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 6_000, seed: int = 5) -> Scorer:
    """Count votes over all documents, run EM, and fit the linear scorer on ``sample_docs`` documents at most
    (those of smallest id hash).  Without both classes in the sample the scorer is the posterior's constant."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    text, at = F.col(text_col), F.xxhash64(F.lit(seed), F.col(id_col))
    voted = materialise(docs.select(at.alias("at"), vote_column(text).alias("votes")), "quality-votes")
    counts = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}  # at most 3 ** labellers rows
    posterior = fit_labellers(counts)
    if not posterior:
        return Scorer(posterior, np.zeros(DIM), -3.0)
    edge = smallest_hashes(voted, F.col("at"), sample_docs).agg(F.max("at")).first()[0]
    sample = docs.filter(at <= F.lit(edge)).limit(2 * sample_docs)
    rows = materialise(sample.select(_features(text, posterior).alias("f")).select("f.x", "f.p"), "quality-sample")
    rows = rows.select(array_to_vector("x").alias("features"), (F.col("p") >= 0.5).cast("double").alias("label"),
                       F.abs(2 * F.col("p") - 1).alias("weight"))
    classes = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(classes) < 2:
        return Scorer(posterior, np.zeros(DIM), 3.0 if classes != {0.0} else -3.0)
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=True).fit(rows)
    return Scorer(posterior, model.coefficients.toArray(), float(model.intercept))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **fit) -> DataFrame:
    """One row per document: id, score, keep, posterior, votes.

    Null and wordless texts have score 0 and are rejected.  Repeated rows are judged alike, ties at the
    threshold are kept, an empty table gives no rows, and other columns are ignored.
    """
    scorer = train(docs, id_col, text_col, **fit)
    judged = docs.select(F.col(id_col), scorer.judge(F.col(text_col)).alias("j"))
    return judged.select(id_col, "j.score", (F.col("j.score") >= threshold).alias("keep"), "j.posterior", "j.votes")


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, **fit) -> DataFrame:
    """The documents that the classifier keeps, with their own columns.

    Null and wordless texts go; repeated rows stay or go alike, ties at the threshold stay, and an empty table gives no rows.
    """
    scorer = train(docs, text_col=text_col, **fit)
    return docs.filter(scorer.judge(F.col(text_col))["score"] >= threshold)
