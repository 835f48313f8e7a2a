import random

import numpy as np
import pytest

from lapdeck.llm import leaks


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
    return row[-1]


def test_bit_parallel_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = (rng.choices(range(6), k=rng.randint(1, 40)) for _ in range(2))
        pattern = {}
        for i, x in enumerate(a):
            pattern[x] = pattern.get(x, 0) | 1 << i
        assert leaks.common_words(pattern, len(a), b) == lcs(a, b)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    stop = ["the", "of", "and", "to", "in", "a"]
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(900)]

    def prose(n):
        return [rng.choice(stop) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]

    items = [(k, prose(n)) for k, n in enumerate((15, 22, 30, 40, 48, 60, 100, 18, 33, 55))]
    bench = [(k, " ".join(w[:-6]) + ". " + " ".join(w[-6:]) + ".") for k, w in items]
    docs, want = [], set()
    for i in range(120):
        w = prose(rng.choice((20, 90, 300)))
        if i % 4 == 0:
            k = i // 4 % 10
            words = bench[k][1].split()
            if i % 8 == 0:  # a paraphrase: some words changed
                for _ in range(len(words) // 10):
                    words[rng.randrange(len(words) - 7)] = rng.choice(vocab)
            at = rng.randint(0, len(w))
            w[at:at] = words
            want.add((i, k))
        docs.append((i, " ".join(w), "en", "s"))
    return docs, bench + [(50, None), (51, ""), (None, None)], want


@pytest.mark.parametrize("block", [4_000, 4])
def test_planted_items_are_found_and_others_left(spark, make_docs, tables, block):
    docs, bench, want = tables
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = leaks.find_leaks(make_docs(docs), b, block=block).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    text = {d[0]: d[1] for d in docs}
    for r in got:
        assert 0 <= r.start < r.end <= len(text[r.doc_id]) and r.lcs >= 0.6


def test_documents_that_leak_go(spark, make_docs, tables):
    docs, bench, want = tables
    extra = [(900, None, None, None), (901, "", None, None), (None, docs[0][1], None, None), (0, docs[0][1], "en", "s"), (902, docs[1][1] + " w" * 100_000 + " " + bench[3][1], "en", "s")]
    out = leaks.without_leaks(make_docs(docs + extra), spark.createDataFrame(bench, "item_id long, text string"))
    bad = {i for i, _ in want}
    assert sorted(r.doc_id for r in out.collect()) == sorted([d[0] for d in docs if d[0] not in bad] + [900, 901])
    assert out.columns == make_docs([]).columns


def test_empty_sides(spark, make_docs, tables):
    b = spark.createDataFrame(tables[1], "item_id long, text string")
    assert leaks.find_leaks(make_docs([]), b).collect() == []
    assert leaks.find_leaks(make_docs(tables[0]), b.limit(0)).collect() == []
    assert leaks.find_leaks(make_docs(tables[0]), b.filter("item_id > 49")).collect() == []


def test_sketch_finds_the_leading_space():
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((60, 5)))[0]
    counts = np.abs(rng.standard_normal((400, 5)) @ basis.T * 40).round().astype(int)
    passage, term = np.nonzero(counts)
    passage, term = (np.repeat(x, counts[passage, term] if x is passage else counts[np.nonzero(counts)]) for x in (passage, term))
    start = rng.standard_normal((60, 20)).astype(np.float32)
    z = np.zeros((60, 20))
    leaks.add_products(z, start, passage, term)
    assert np.allclose(z, counts.T @ (counts @ start.astype(float)), rtol=1e-3, atol=1e-1)


def test_paraphrases_near_the_limits_are_candidates(spark, make_docs):
    rng = random.Random(21)
    stop = ["the", "of", "and", "to", "in", "a"]
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(900)]

    def prose(n):
        return [rng.choice(stop) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]

    bench, docs, want = [], [], set()
    for k in range(150):
        w = prose(rng.randint(16, 60))
        bench.append((k, " ".join(w[:-6]) + ". " + " ".join(w[-6:]) + "."))
    for i in range(300):
        k = i % 150
        w = bench[k][1].split()
        kept = 0.76 if i < 150 else 0.62
        changed = set(rng.sample(range(len(w) - 6), min(len(w) - 6, int((1 - kept) * len(w)))))
        planted = [rng.choice(vocab) if j in changed else x for j, x in enumerate(w)]
        assert lcs(w, planted) >= kept * len(w)
        text = prose(120)
        text[60:60] = planted
        docs.append((i, " ".join(text), "en", "s"))
        want.add((i, k))
    got = leaks.find_leaks(make_docs(docs), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert len(want - {(r.doc_id, r.item_id) for r in got}) <= 0.01 * len(want)
