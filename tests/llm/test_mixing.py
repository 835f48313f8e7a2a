import re

import pytest

from lapdeck.llm import mixing


def levels(sizes, weights=(5, 2, 1), share=1.0, epochs=3):
    """Reshare the excess until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()) * share, set()
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(epochs * sizes[s] for s in fixed)
        t = {s: epochs * sizes[s] for s in fixed} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > epochs * sizes[s] + 1e-9}
        if not over:
            return t
        fixed |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, None: 3}, {"b": 7}, {"a": 0, "b": 90}, {f"s{i}": 5 ** (i % 5) for i in range(17)}])
def test_targets_equal_the_iterated_definition(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = levels(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.fixture(scope="module")
def rows():
    docs = [(i, "w " * (1 + i * 7 % 23), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(600)]
    return docs + [(600, None, "en", "hot"), (601, " \n", "en", None), (602, "a b", None, None), (None, "x y z", None, "hot"), (5, "w w", None, "s1"), (5, "w w", None, "s1")]


def test_plan_is_near_its_targets_and_repeatable(make_docs, rows):
    plans = [sorted(((r.doc_id is None, r.doc_id, r["size"], r.copies, round(r.target, 6)) for r in mixing.mix_plan(make_docs(rows, p), rows_per_bucket=50).collect()), key=str)
             for p in (2, 7)]
    assert plans[0] == plans[1]
    plan = mixing.mix_plan(make_docs(rows), rows_per_bucket=50).collect()
    assert len(plan) == len(rows)
    size = {}
    for _, text, _, source in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = levels(size)
    taken = dict.fromkeys(size, 0)
    for r in plan:
        assert 0 <= r.copies <= 3 and r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r["size"] * r.copies
    assert sum(taken.values()) <= sum(size.values())
    assert all(abs(taken[s] - target[s]) <= 2 * 23 for s in size)


def test_buckets_do_not_change_the_mix(make_docs, rows):
    one, many = ({(r.doc_id, r["size"]): r.copies for r in mixing.mix_plan(make_docs(rows), rows_per_bucket=n).collect()} for n in (10_000, 7))
    assert one == many


def test_mixed_documents_and_stream(make_docs, rows):
    docs = make_docs([r for r in rows if r[0] is not None and r[0] != 5])
    out = mixing.mixed_documents(docs)
    assert set(docs.columns) <= set(out.columns) and out.filter("copies = 0").isEmpty()
    plan = mixing.mix_plan(docs)
    stream = [(r.virtual_finish, r.doc_id) for r in mixing.mixed_stream(docs, plan, partitions=4).collect()]
    assert stream == sorted(stream) and len(stream) == plan.selectExpr("sum(copies)").first()[0]


def test_empty_and_wordless(make_docs):
    assert mixing.mix_plan(make_docs([])).collect() == []
    rows = mixing.mix_plan(make_docs([(1, None, None, "a"), (2, "", None, None)])).collect()
    assert sorted((r.doc_id, r["size"], r.copies, r.target) for r in rows) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
