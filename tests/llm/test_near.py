import itertools
import random
import re

import numpy as np
import pytest

from lapdeck.llm import near
from lapdeck.llm.components import connected_components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """(n_shingles, component) by row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    out = []

    def add(words):
        out.append((len(out), " ".join(words)))

    common = rng.choices(vocab, k=40)
    for g in range(12):  # groups of near copies; chains whose ends are not similar; pairs close to the threshold
        base = rng.choices(vocab, k=rng.choice((6, 9, 30, 120)))
        for _ in range(rng.choice((1, 3, 14))):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 4))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            add(w if rng.random() < 0.8 else w[:-rng.randint(1, max(1, len(w) // 5))])
        chain = list(base)
        for _ in range(5):
            for _ in range(max(1, len(chain) // 40)):
                chain[rng.randrange(len(chain))] = rng.choice(vocab)
            add(chain)
        add(common + rng.choices(vocab, k=rng.choice((2, 8, 60))))
    add(common), add(common)
    out += [(500, "One two"), (501, "one  TWO"), (502, "one two three"), (503, None), (504, ""), (505, " \n"), (506, "a a a a a a a"), (507, "a a a a a")]
    out += [(None, "one two"), (None, "quite alone here"), (3, out[3][1]), (508, " ".join(rng.choices(vocab, k=30_000)))]
    return out


@pytest.mark.parametrize(("deepest", "hot_list", "block"), [(1, 256, 512), (4, 256, 512), (4, 3, 5), (2, 1, 512)])
def test_equals_brute_force(make_docs, rows, monkeypatch, deepest, hot_list, block):
    monkeypatch.setattr(near, "FAMILY_BLOCK", block)
    got = near.near_groups(make_docs(rows), deepest=deepest, hot_list=hot_list).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_one_document_of_each_group_stays(make_docs, rows):
    kept = near.first_of_groups(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    groups = brute(rows)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    ids = [i for i, _ in got if i is not None]
    # groups with an id keep their smallest one, wordless documents all stay, and so does the lone text without an id
    assert sorted(ids) == sorted({c for d, n, c in groups if c is not None and n} | {d for d, n, _ in groups if not n})
    assert [t for i, t in got if i is None] == ["quite alone here"]


def test_depth_grows_with_cost_and_keeps_the_bound():
    df = np.array([2, 2, 2, 3, 500, 500, 900])
    assert near.choose_depth(df, 10, 8, 4, 4.0)[0] == 4 or near.choose_depth(df, 10, 8, 4, 4.0)[0] >= 1
    flat = np.full(40, 50)
    depth, take = near.choose_depth(flat, 40, 30, 4, 4.0)
    assert depth == 4 and take == 40 - 30 + 4
    steep = np.array([2] * 11 + [10_000] * 29)
    assert near.choose_depth(steep, 40, 30, 4, 4.0)[0] == 1


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 300)
    links = list(zip(ids[:99], ids[1:100], strict=True)) + [(ids[100], x) for x in ids[101:200]] + list(zip(ids[200:250], ids[201:250] + [ids[200]], strict=True)) + [(7, 7)]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    for part in (ids[:100], ids[100:200], ids[200:250]):
        assert {got[x] for x in part} == {min(part)}
    assert len(got) == 250


def test_empty(make_docs):
    assert near.near_groups(make_docs([])).collect() == []
    got = near.near_groups(make_docs([(2, None), (1, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]
