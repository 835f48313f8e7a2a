import random

import numpy as np
import pytest

from lapdeck.llm import quality


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    out = []
    for i in range(500):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        text, good = ". ".join(" ".join(words[a:a + 9]).capitalize() for a in range(0, len(words), 9)) + ".", True
        if i % 8 == 0:
            good, kind = False, i // 8 % 4
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "### "), " | ".join(words), " ".join(w for w in words[:12] for _ in range(9))][kind]
        out.append((i, text, good))
    return out


def test_held_against_the_labels(make_docs, rows):
    got = {r.doc_id: r for r in quality.classify(make_docs([r[:2] for r in rows])).collect()}
    good = [got[i].keep for i, _, g in rows if g]
    bad = [got[i].keep for i, _, g in rows if not g]
    assert len(got) == len(rows) and np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    patterns: dict[str, int] = {}
    truth = []
    for _ in range(4000):
        good = rng.random() < 0.8
        v = "".join(("1" if rng.random() < 0.7 else "-") if good else ("0" if rng.random() < 0.6 else "-" if rng.random() < 0.7 else "1") for _ in range(5))
        patterns[v] = patterns.get(v, 0) + 1
        truth.append((v, good))
    p = quality.fit_labellers(patterns)
    assert np.mean([(p[v] >= 0.5) == g for v, g in truth]) > 0.93
    assert quality.fit_labellers({}) == {}


def test_edges(make_docs, rows):
    base = [r[:2] for r in rows[:120]]
    edge = [(900, None), (901, ""), (902, " \n\t"), (903, "Fine."), (None, rows[1][1]), (1, rows[1][1]), (904, (rows[1][1] + "\n") * 3000), (905, "x" * 200_000)]
    got = quality.classify(make_docs(base + edge)).collect()
    assert len(got) == len(base) + len(edge)
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].score, by_id[i].keep) == (0.0, False) for i in (900, 901, 902))
    assert len({(r.score, r.keep) for r in got if r.doc_id in (None, 1)}) == 1
    kept = quality.keep_good(make_docs(base + edge))
    assert kept.columns == make_docs([]).columns and kept.count() == sum(r.keep for r in got)


def test_empty(make_docs):
    assert quality.classify(make_docs([])).collect() == []
    assert [r.keep for r in quality.classify(make_docs([(1, None)])).collect()] == [False]
