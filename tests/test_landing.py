"""The bucket of the landed queries: lines meet their orders once, and only the columns that objects are made of are dealt to sessions."""

import datetime as dt

import pytest

from lapdeck.plans import q_landed as Q
from lapdeck.sources.landed import read_landed
from lapdeck.sources.sinks import write_objects

KEYS = ["year", "event", "session"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    roles = list(Q.ROLES)
    orders = [(k, k % 7, "O", 1000.0 + k, dt.datetime(1995 + k % 2, 1 + k % 12, 5), roles[k % 5]) for k in range(120)] + [(None, None, None, None, None, None)]
    lines = [(k, 3 * k + n, k + n, n, 5.0 + n, 900.0 + k, 0.05, 0.02, "R" if k % 3 else "N") for k in range(120) for n in (1, 2)] + [(None,) * 9]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
                          ).write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double, l_returnflag string").write.parquet(f"{root}/lineitem.parquet")
    return root


def test_lines_meet_orders_once(spark, tables, monkeypatch):
    written = []

    def recorded(df, root, data_type, *a, shape=lambda d: d, **k):
        def told(dealt):
            written.append((data_type, _plan(df), len(dealt.columns), len(shape(dealt).columns), _plan(shape(dealt))))
            return shape(dealt)
        return write_objects(df, root, data_type, *a, shape=told, **k)

    monkeypatch.setattr(Q, "write_objects", recorded)
    root = Q._land(spark, tables)
    laps = [w for w in written if w[0] == "laps"]
    assert len(laps) == 3 and not any("Join" in plan for _, plan, *_ in laps)
    dealt = [w for w in written if w[0] in ("laps", "results")]
    assert all("RebalancePartitions" in w[4] for w in dealt) and sum(made > narrow for _, _, narrow, made, _ in dealt) >= 6
    # every row, in the declared units whatever version wrote it
    rows = {(r.year, r.event, r.session, r.Time): r for r in read_landed(spark, root, "laps").collect()}
    roles = {k: list(Q.ROLES.values())[k % 5] for k in range(120)}
    run = [k for k in range(120) if roles[k] in ("Race", "Qualifying") and (1995 + k % 2, (k % 12) // 3 + 1, roles[k]) != (1996, 3, "Qualifying")]
    assert len(rows) == len(run)  # two lines of an order have one time
    k = next(k for k in run if (k % 12) // 3 == 1)  # a second quarter: times as text
    lap = rows[(1995 + k % 2, "round_2_gp", roles[k], round(k + (900.0 + k) / 1e6, 6))]
    assert lap.LapTime in (66.0, 67.0) and lap.DriverNumber == str(k % 7)


def test_shape_follows_the_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F
    seen = []

    def shape(dealt):
        out = dealt.select(*KEYS, F.concat(F.lit("wide "), "x").alias("wide"))
        seen.append(_plan(out))
        return out

    df = spark.createDataFrame([(1995, "a", "Race", 1), (1995, "a", "Race", 2), (1996, "b", "Race", 3)], "year int, event string, session string, x int")
    assert write_objects(df, str(tmp_path), "t", shape=shape) == 2
    assert seen[0].index("wide") < seen[0].index("RebalancePartitions") and "wide" not in seen[0][seen[0].index("RebalancePartitions"):]
    assert sorted(r.wide for r in spark.read.parquet(f"{tmp_path}/1995/a/Race/t.parquet").collect()) == ["wide 1", "wide 2"]
