import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapdeck.llm import variants

ALPHABET = "abé×z"


def edits(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out.add(word[:i] + word[i + 1:])
            out |= {word[:i] + c + word[i + 1:] for c in letters}
    return out - {word}


def brute(docs):
    n = Counter()
    for i, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = "".join(c for k, c in enumerate(run) if k != h % len(run))
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    letters = {c for w in n for c in w}
    near = {w: sorted(e for e in edits(w, letters) if e in n) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeéghilmnortuÇ") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words = stems + [rng.choice(sorted(edits(rng.choice(stems), "abcdeé"))) for _ in range(240)]
    words += ["".join(rng.sample(w, len(w))) for w in stems[:10]] + ["x" * 400, "x" * 401, "y" + "x" * 399]
    weight = [1 / (1 + k % 60) for k in range(len(words))]
    out = []
    for i in range(400):
        some = rng.choices(words, weight, k=rng.choice((3, 20, 60)))
        out.append((i, rng.choice((" ", ", ", "\n", " 7 ")).join(w.upper() if rng.random() < 0.1 else w for w in some)))
    return out + [(900, None), (901, ""), (902, "12 345 -- Ω"), (None, out[0][1]), (0, out[0][1]), (903, "x" * 400 + " " + "abcde " * 9000), (904, "x" * 400), (905, "x" * 401 + " " + "x" * 401 + "-" + "X" * 401)]


@pytest.mark.parametrize("leaf,sample", [(1_000, 60_000), (20, 60_000), (40, 25)])
def test_against_all_edits(make_docs, docs, leaf, sample):
    got = variants.spelling_variants(make_docs(docs, 5), leaf=leaf, sample_words=sample).collect()
    want = brute(docs)
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got) == want
    assert any(r[3] and r[3] != r[5] for r in want)  # chains


def test_empty(make_docs):
    assert variants.spelling_variants(make_docs([])).collect() == []
    assert variants.spelling_variants(make_docs([(1, None), (2, "abc abc abc")])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(ALPHABET, min_size=3, max_size=3), min_size=1, max_size=40, unique=True),
       st.lists(st.text(ALPHABET, min_size=2, max_size=2), max_size=20, unique=True), st.integers(1, 40))
def test_pairs_in_a_box(own, shorter, leaf):
    import numpy as np
    words, kinds = own + shorter, np.array([variants.OWN] * len(own) + [variants.SHORTER] * len(shorter))
    a, b = variants.near_in_box(words, kinds, leaf=leaf, pairs=50)
    got = sorted(tuple(sorted((words[i], words[j]))) for i, j in zip(a, b, strict=True))
    want = sorted({tuple(sorted((x, y))) for y in own for x in words if x in edits(y, ALPHABET)})
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(ALPHABET, min_size=3, max_size=5), min_size=1, max_size=60, unique=True), st.integers(1, 20), st.integers(1, 30))
def test_boxes_hold_each_pair_once(words, sample, leaf):
    some = {}
    for w in words[:sample]:
        some.setdefault(len(w), []).append(w)
    boxes = variants.Boxes.fit(Counter(map(len, words)), some, leaf)
    dealt = {}
    for box, kind, at in boxes.deal(words):
        for i in at:
            dealt.setdefault(box, []).append((words[i], kind))
    import numpy as np
    got = []
    for rows in dealt.values():
        a, b = variants.near_in_box([w for w, _ in rows], np.array([k for _, k in rows]))
        got += [tuple(sorted((rows[i][0], rows[j][0]))) for i, j in zip(a, b, strict=True)]
    want = {tuple(sorted((x, y))) for x in words for y in words if y in edits(x, ALPHABET)}
    assert sorted(got) == sorted(want)
