"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    import datetime as _dt

    import pandas as pd
    if isinstance(v, (_dt.date, _dt.datetime, pd.Timestamp)):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, query, sf_dir):
    t0 = time.time()
    sdf = query.build(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if query.sql is None:
        return {"name": name, "status": "rows-only", "rows": len(spdf), "spark_s": round(t1 - t0, 2)}
    opdf = con.sql(query.sql).df()
    scols, srows = _rows(spdf)
    ocols, orows = _rows(opdf)
    res = {"name": name, "rows": len(srows), "oracle_rows": len(orows), "spark_s": round(t1 - t0, 2)}
    if scols != ocols:
        res.update(status="schema", spark_cols=scols, oracle_cols=ocols)
    elif srows != orows:
        diff = [(a, b) for a, b in zip(srows, orows) if a != b][:3]
        res.update(status="values", first_diffs=diff)
    else:
        res["status"] = "ok"
    return res


def main(argv):
    import duckdb

    from lapdeck.plans.registry import load_all
    from lapdeck.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "error", "error": str(e)[:800]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"FAILED: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
