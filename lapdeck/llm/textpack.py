"""Words and hashes of many texts at once, as numpy arrays (used inside ``mapInPandas`` tasks).

A text becomes UTF-8 bytes with A-Z lower-cased; words are runs of bytes other than the six
ASCII blanks, which is the same as runs of such characters, since no byte of a longer
UTF-8 character is ASCII.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

U = np.uint64
# Odd 64-bit multipliers (fixed, so that hashes agree between tasks and runs).
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LONG_WORD = 4096


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = (h ^ (h >> U(32))) * K1
    h = (h ^ (h >> U(29))) * K2
    return h ^ (h >> U(32))


def parts(texts: Sequence[str | None], max_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with at most ``max_chars`` characters, or one text."""
    lo, chars = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and chars + n > max_chars:
            yield lo, i
            lo, chars = i, 0
        chars += n
    if lo < len(texts):
        yield lo, len(texts)


@dataclass
class Words:
    """``data``: lower-cased bytes of all texts, one blank between them (and 8 zero bytes behind).
    ``text_at``: where each text begins, and the end.  ``start``, ``size`` (bytes), ``text``: by word."""

    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word, and the number of words."""
        return np.searchsorted(self.text, np.arange(len(self.text_at)))


def words(texts: Sequence[str | None], lower: bool = True) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    text_at = np.concatenate([[0], np.cumsum(np.fromiter((len(x) + 1 for x in raw), np.int64, len(raw)))]).astype(np.int64)
    joined = b"\n".join(raw)
    data = np.frombuffer((joined.lower() if lower else joined) + b"\n" + bytes(8), np.uint8)
    solid = np.concatenate([[False], ~BLANK[data[:-8]]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    return Words(data, text_at, start, end - start, np.searchsorted(text_at, start, "right") - 1)


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of each word."""
    eight = np.ndarray((len(w.data) - 7,), "<u8", w.data, 0, (1,))  # the 8 bytes from every position
    h = w.size.astype(U) * K3
    todo = np.arange(len(h))
    for k in range(0, LONG_WORD, 8):
        todo = todo[w.size[todo] > k] if k else todo
        if not len(todo):
            break
        v = eight[w.start[todo] + k]
        left = w.size[todo] - k
        short = left < 8
        v[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        h[todo] = scramble(h[todo] ^ v)
    for i in np.flatnonzero(w.size > LONG_WORD):
        whole = w.data[w.start[i]:w.start[i] + w.size[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
    return h


def shingles(w: Words, size: int = 5, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct ``size``-word shingles, by text and hash.

    A text with fewer words has its whole word sequence as its one shingle; one without words has none.
    """
    h = word_hashes(w) if h is None else h
    factor = [scramble(np.array([j + 1], U))[0] | U(1) for j in range(size)]
    first = w.first
    count = np.diff(first)
    n = max(0, len(h) - size + 1)
    g = np.zeros(n, U)
    for j in range(size):
        g += h[j:j + n] * factor[j]
    full = w.text[:n] == w.text[size - 1:] if n else np.zeros(0, bool)
    text, g = w.text[:n][full], scramble(g[full])
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        own = np.array([sum((int(h[first[t] + j]) * int(factor[j]) for j in range(count[t])), int(count[t])) % 2**64 for t in few], U)
        text, g = np.concatenate([text, few]), np.concatenate([g, scramble(own)])
        order = np.argsort(text, kind="stable")
        text, g = text[order], g[order]
    g = np.ascontiguousarray(g)
    at = np.searchsorted(text, np.arange(len(count) + 1))
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a > 1:
            g[a:b].sort()
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (text[1:] != text[:-1])
    return text[new], g[new]
