import random

import pytest

from lapdeck.llm import hamming


def brute(queries, rows, k):
    out = []
    for q, a in {(q, a) for q, a in queries if q is not None and a is not None}:
        near = sorted((bin((a ^ b) & (2**64 - 1)).count("1"), i) for i, b in {(i, b) for i, b in rows if i is not None and b is not None})
        out += [(q, i, d, n + 1) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize(("segments", "block"), [(None, 20_000), (16, 3), (4, 20_000)])
def test_equals_brute_force(spark, monkeypatch, segments, block):
    monkeypatch.setattr(hamming, "CODES_PER_TASK", 20)
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(6)]
    rows = []
    for i in range(240):  # near one of a few centres, a large group of one code, far outliers
        c = rng.choice(base)
        for _ in range(rng.choice((0, 1, 3, 12))):
            c ^= 1 << rng.randrange(64)
        rows.append((i, signed(base[0] if i % 3 == 0 else c)))
    rows += [(None, 5), (281, None), (282, signed(rows[7][1] & (2**64 - 1) ^ (2**64 - 1))), rows[9]]
    queries = [r for r in rows if r[0] is None or r[0] % 40 == 0 or r[0] > 280]
    t = [spark.createDataFrame(x, "id long, code long").repartition(3) for x in (queries, rows)]
    got = sorted(tuple(r) for r in hamming.search(*t, k=5, segments=segments, block=block).select("query_id", "neighbor_id", "distance", "rank").collect())
    assert got == brute(queries, rows, 5)


def test_few_rows_and_empty(spark):
    rows = spark.createDataFrame([(1, 0), (2, 7)], "id long, code long")
    got = sorted(tuple(r) for r in hamming.search(rows, rows, k=9).collect())
    assert got == [(1, 1, 0, 1), (1, 2, 3, 2), (2, 1, 3, 2), (2, 2, 0, 1)]
    assert hamming.search(rows, rows.limit(0)).collect() == [] and hamming.search(rows.limit(0), rows).collect() == []


def test_other_columns_are_ignored(spark):
    rows = spark.createDataFrame([(1, 0, 5, 6, 7, "x", 8), (2, 7, 5, 6, 7, "x", 8)],
                                 "id long, code long, distance int, rank int, q long, neighbor_id string, copy int")
    got = sorted(tuple(r) for r in hamming.search(rows, rows, k=1).collect())
    assert got == [(1, 1, 0, 1), (2, 2, 0, 1)]


def test_sign_code(spark):
    v = [[1.0] * 64, [-1.0] * 64, None, [0.0] * 63, [None] + [1.0] * 63, [-0.5] + [0.5] * 63]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "id long, v array<float>")
    got = [r.c for r in rows.select("id", hamming.sign_code(rows.v).alias("c")).orderBy("id").collect()]
    assert got == [-1, 0, None, None, None, -2]
