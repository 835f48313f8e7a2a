"""Every registered query against its DuckDB oracle (sf0.001 and, for the
sequence family, sf0.01)."""

import os

import pytest

from folders import SF001, SF01
from lapdeck.plans.registry import load_all

REG = load_all()
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    cons = {}
    for sf in (SF001, SF01):
        if not os.path.isdir(sf):
            continue
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        cons[sf] = con
    return cons


def _check(spark, duck, name, sf):
    import sys
    from pathlib import Path
    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
    from oracle_check import compare
    if sf not in duck:
        pytest.skip("test data missing")
    r = compare(spark, duck[sf], name, REG[name], sf)
    assert r["status"] in ("ok", "rows-only"), r


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle_sf0001(spark, duck, name):
    _check(spark, duck, name, SF001)


@pytest.mark.parametrize("name", sorted(n for n in REG if n.startswith("seq_")))
def test_sequence_queries_sf001(spark, duck, name):
    _check(spark, duck, name, SF01)


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = {n for n, q in REG.items() if q.sql is None}
    assert not rows_only, rows_only
