"""Alignment of two tokenizers' tokens over the same bytes.

1. Every whole text is tokenised by A (byte-level BPE) and B (a sentencepiece model), each token becomes its bytes, and both
   token sequences must spell the same bytes.
2. Anchors: a byte offset where a token of A and a token of B both end, and both next tokens begin with the space mark.
   Anchors are verified by the running byte lengths of both sequences, never guessed.  They split a text into short windows.
3. A window is a tuple of A ids and a tuple of B ids; its alignment (the groups between shared ends) follows from these alone, so
   it is worked out when a window is first seen, for all new windows of some texts at once, and looked up again.  The memory of
   windows is emptied between texts when it is full, which costs time and changes nothing.
4. The tokens that end together are links.  Links are counted per (A id, B id) over the corpus by Spark, and the counts are joined
   back to each text's distinct links.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapdeck.llm import textpack as tp
from lapdeck.llm.common import materialise, small_batches

TOKENIZERS = "/opt/tokenizers"
PART = 250_000
WINDOWS = 300_000
MARK = "▁"
#: The word pattern of A's byte-level pre-tokeniser (fixed by that kind of tokenizer).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ------------------------------------------------------------------------------------- tokenizers
def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A from the text of its JSON file: ids of a text, and each id's bytes.

    Where merges are ranked by the ids they make (checked here), tiktoken gives the same ids from the vocabulary alone and is
    four times as fast; else the tokenizers library encodes.
    """

    def __init__(self, source: str):
        model = json.loads(source)
        vocab, alphabet = model["model"]["vocab"], byte_alphabet()
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for entry, i in vocab.items():
            self.bytes[i] = entry.encode() if entry in special else bytes(alphabet[c] for c in entry)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        ranked = all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        as_expected = not model.get("normalizer") and {k: (model.get("pre_tokenizer") or {}).get(k) for k in plain} == plain
        if ranked and as_expected:
            import tiktoken

            ranks = {self.bytes[i]: i for e, i in vocab.items() if e not in special}
            own = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [np.array(own.encode_ordinary(t), np.int32) for t in texts]
        else:
            from tokenizers import Tokenizer

            other = Tokenizer.from_str(source)
            other.encode_special_tokens = True
            self.encode = lambda texts: [np.array(e.ids, np.int32) for e in other.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B from the bytes of its sentencepiece model."""

    def __init__(self, source: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]
        self.encode = lambda texts: [np.array(ids, np.int32) for ids in model.encode(texts, num_threads=1)]


# ----------------------------------------------------------------------------------------- windows
def windows_of(end_a: np.ndarray, end_b: np.ndarray, space_a: np.ndarray, space_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many tokens of A and of B each window ends behind, and at which byte.  ``end``: byte offsets; ``space``: tokens with the
    space mark in front."""
    cut_a, cut_b = np.flatnonzero(space_a[1:]), np.flatnonzero(space_b[1:])  # the tokens before such ones
    at, i, j = np.intersect1d(end_a[cut_a], end_b[cut_b], assume_unique=True, return_indices=True)
    return np.append(cut_a[i] + 1, len(end_a)), np.append(cut_b[j] + 1, len(end_b)), np.append(at, end_a[-1:])


def groups_of(a: list[int], b: list[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


class _Numbers(dict):
    """Numbers of windows by their ids, in the order in which they were first seen."""

    def __missing__(self, key: bytes) -> int:
        w = self[key] = len(self)
        return w


class Aligner:
    """Works in one task.  Alignments are remembered by the window's id tuples, written as one run of numbers."""

    def __init__(self, source_a: str, source_b: bytes, room: int = WINDOWS):
        self.a, self.b, self.room = ByteLevel(source_a), Pieces(source_b), room
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b))
        self.n_b = len(self.b.bytes)
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.text: list[str] = []  # by window: its groups as a1,a2|b1;a3|b2,b3
        self.first, self.link = array("q", [0]), array("q")  # its links, a * n_b + b, are link[first[w]:first[w + 1]]

    def windows(self, a: np.ndarray, b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the windows of several texts' tokens, one text behind the other, and the byte where each ends.  ``begin``: each
        text's first token; the texts' tokens of A and B spell the same bytes."""
        space_a, space_b = self.space_a[a], self.space_b[b]
        space_a[begin_a], space_b[begin_b] = True, True  # no window reaches into the next text
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        stop_a, stop_b, at = windows_of(end_a, end_b, space_a, space_b)
        # each window as its A ids, -1, its B ids
        n = np.arange(len(stop_a))
        own_a, own_b = np.repeat(n, np.diff(stop_a, prepend=0)), np.repeat(n, np.diff(stop_b, prepend=0))
        ids = np.full(len(a) + len(b) + len(n), -1, np.int32)
        ids[np.arange(len(a)) + np.concatenate([[0], stop_b[:-1]])[own_a] + own_a] = a
        ids[np.arange(len(b)) + stop_a[own_b] + own_b + 1] = b
        raw, known, ends, old = ids.tobytes(), self.known, (4 * (stop_a + stop_b + n + 1)).tolist(), len(self.known)
        w = np.array([known[raw[i:j]] for i, j in zip([0, *ends], ends, strict=False)])
        fresh = np.flatnonzero(w >= old)
        # numbers were given in order: the first window of each new number
        self._learn(fresh[np.unique(w[fresh], return_index=True)[1]], a, b, end_a, end_b, at)
        return w, at

    def _learn(self, new: np.ndarray, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, at: np.ndarray) -> None:
        """Align the windows ``new``: every byte where a token of either side ends is the end of a group."""
        flag = np.zeros(at[-1] + 1, bool)
        flag[end_b] = True
        j_a = np.flatnonzero(flag[end_a])  # the tokens that end together
        flag[end_b] = False
        flag[end_a] = True
        j_b = np.flatnonzero(flag[end_b])
        last = np.searchsorted(end_a[j_a], at, "right")  # groups up to each window's end
        from_, to = np.concatenate([[0], last[:-1]])[new], last[new]
        size = to - from_
        stop = np.cumsum(size)
        g = np.arange(size.sum()) + np.repeat(from_ - (stop - size), size)
        i, j = j_a[g], j_b[g]
        x, y = a[i], b[j]
        texts = [f"{p}|{q}" for p, q in zip(x.tolist(), y.tolist(), strict=True)]
        begin_a, begin_b = np.where(g > 0, j_a[g - 1] + 1, 0), np.where(g > 0, j_b[g - 1] + 1, 0)
        several, all_a, all_b = np.flatnonzero((i > begin_a) | (j > begin_b)), a.tolist(), b.tolist()
        for k, p, q, r, t in zip(several.tolist(), *(v[several].tolist() for v in (begin_a, i + 1, begin_b, j + 1)), strict=True):
            texts[k] = groups_of(all_a[p:q], all_b[r:t])
        cuts = stop.tolist()
        self.text += [";".join(texts[p:q]) for p, q in zip([0, *cuts], cuts, strict=False)]
        self.first.frombytes((stop + len(self.link)).astype(np.int64).tobytes())
        self.link.frombytes((x.astype(np.int64) * self.n_b + y).tobytes())

    def _spells(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        return b"".join(map(self.a.bytes.__getitem__, a.tolist())) == text == b"".join(map(self.b.bytes.__getitem__, b.tolist()))

    def part(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(n_a, n_b, groups_sha256) by text, and (text, link) of every link in order."""
        if len(self.known) >= self.room:
            self.forget()
        n_a, n_b, sha = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [""] * len(texts)
        some = [i for i, t in enumerate(texts) if t and _encodable(t)]
        both = zip(some, self.a.encode([" " + texts[i] for i in some]), self.b.encode([texts[i] for i in some]), strict=True)
        spelt = [(i, a, b) for i, a, b in both if self._spells(b" " + texts[i].encode(), a, b)]
        if not spelt:
            return n_a, n_b, sha, np.zeros(0, np.int64), np.zeros(0, np.int64)
        size_a, size_b = np.array([len(a) for _, a, _ in spelt]), np.array([len(b) for _, _, b in spelt])
        end = np.cumsum([1 + len(texts[i].encode()) for i, _, _ in spelt])
        w, at = self.windows(np.concatenate([a for _, a, _ in spelt]), np.concatenate([b for _, _, b in spelt]),
                             np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b)
        cuts, whole = np.searchsorted(at, end, "right").tolist(), np.array([i for i, _, _ in spelt])
        n_a[whole], n_b[whole] = size_a, size_b
        windows = w.tolist()
        for i, x, y in zip(whole.tolist(), [0, *cuts], cuts, strict=False):
            sha[i] = hashlib.sha256(";".join(map(self.text.__getitem__, windows[x:y])).encode()).hexdigest()
        first, link = np.frombuffer(self.first, np.int64), np.frombuffer(self.link, np.int64)
        size = first[w + 1] - first[w]
        links = link[np.arange(size.sum()) + np.repeat(first[w] - (np.cumsum(size) - size), size)]
        return n_a, n_b, sha, np.repeat(np.repeat(whole, np.diff(cuts, prepend=0)), size), links


def _encodable(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:  # a lone surrogate has no bytes
        return False
    return True


# ------------------------------------------------------------------------------------------- Spark
def aligned(docs: DataFrame, folder: str = TOKENIZERS, file_a: str = "byte_bpe_50k.json", file_b: str = "piece_bpe_32k.model",
            id_col: str = "doc_id", text_col: str = "text", room: int = WINDOWS) -> DataFrame:
    """One row per text: row, id, n_a, n_b, n_groups, groups_sha256, and its distinct links (a * n_b + b) with how often it has them."""
    small_batches(docs.sparkSession)
    a, b = Path(folder, file_a).read_text(encoding="utf-8"), Path(folder, file_b).read_bytes()
    files = docs.sparkSession.sparkContext.broadcast((a, b))  # two vocabulary files of fixed size: workers need no folder
    kind = docs.schema[id_col].dataType.simpleString()

    def align_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*files.value, room)
            texts = batch.column("text").to_pylist()
            for x, y in tp.parts(texts, PART):
                n_a, n_b, sha, doc, link = aligner.part(texts[x:y])
                n_groups = np.bincount(doc, minlength=y - x)
                order = np.lexsort((link, doc))
                doc, link = doc[order], link[order]
                at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (link[1:] != link[:-1])])) if len(doc) else doc
                cuts = pa.array(np.searchsorted(doc[at], np.arange(y - x + 1)), pa.int32())
                own = batch.slice(x, y - x)
                yield pa.RecordBatch.from_pydict({
                    "row": own.column("row"), "id": own.column("id"), "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()),
                    "n_groups": pa.array(n_groups, pa.int64()), "groups_sha256": pa.array(sha, pa.string()),
                    "link": pa.ListArray.from_arrays(cuts, pa.array(link[at])),
                    "times": pa.ListArray.from_arrays(cuts, pa.array(np.diff(np.append(at, len(doc))), pa.int32()))})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(align_all, f"row long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, link array<long>, times array<int>")


def link_counts(texts: DataFrame, n_b: int) -> DataFrame:
    """(link, n, best): how often a link occurs in the corpus, and whether no other link of its B id occurs more often."""
    counts = texts.select(F.inline(F.arrays_zip("link", "times"))).groupBy("link").agg(F.sum("times").alias("n"))
    counts = materialise(counts.withColumn("b", F.col("link") % n_b), "align-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most")).withColumnRenamed("b", "of")
    # one row per id of B at most: as small as its vocabulary
    return counts.join(F.broadcast(most), F.col("b") == F.col("of")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def token_alignment(docs: DataFrame, folder: str = TOKENIZERS, file_a: str = "byte_bpe_50k.json", file_b: str = "piece_bpe_32k.model",
                    id_col: str = "doc_id", text_col: str = "text", room: int = WINDOWS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, texts that either tokenizer doesn't spell byte for byte (B may normalise), and texts with lone
    surrogates have no tokens: zeros and ''.  Special tokens' strings are plain text.  Links that tie for their B id's highest
    count are all best.  Repeated rows count again; an empty table gives no rows; other columns are ignored.
    """
    texts = materialise(aligned(docs, folder, file_a, file_b, id_col, text_col, room), "align-texts")
    n_b = len(Pieces(Path(folder, file_b).read_bytes()).bytes)
    counts = materialise(link_counts(texts, n_b).withColumnRenamed("link", "known"), "align-links")
    # two plain scans: AQE splits the partition of a link that nearly every text has
    held = texts.select("row", F.inline(F.arrays_zip("link", "times"))).join(counts, F.col("link") == F.col("known"))
    sums = held.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("n")).alias("count_sum")).withColumnRenamed("row", "of")
    out = texts.drop("link", "times").join(sums, F.col("row") == F.col("of"), "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                      F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
                      "groups_sha256")
