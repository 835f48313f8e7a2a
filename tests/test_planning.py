"""Planning: event filter, unpivot, the nine scope modes, gaps and session
state, precedence, stamping, session info, overview, ledger."""

import datetime as dt

from pyspark.sql import functions as F

from lapdeck.operators import planning as P

SCHED = ("RoundNumber int, Country string, Location string, OfficialEventName string, "
         "EventDate timestamp_ntz, EventName string, EventFormat string, "
         "Session1 string, Session1DateUtc timestamp_ntz, Session2 string, Session2DateUtc timestamp_ntz, "
         "Session3 string, Session3DateUtc timestamp_ntz, Session4 string, Session4DateUtc timestamp_ntz, "
         "Session5 string, Session5DateUtc timestamp_ntz")


def _schedule(spark):
    d = dt.datetime(2022, 3, 20)
    conv = ["Practice 1", "Practice 2", "Practice 3", "Qualifying", "Race"]
    sprint = ["Practice 1", "Qualifying", "Practice 2", "Sprint", "Race"]
    rows = [(1, "Bahrain", "Sakhir", "O1", d, "Bahrain Grand Prix", "conventional", *sum(([s, d] for s in conv), [])),
            (4, "Italy", "Imola", "O4", d, "Emilia Romagna Grand Prix", "sprint", *sum(([s, d] for s in sprint), [])),
            (0, "Spain", "Barcelona", "T", d, "Pre-Season Test", "testing", "Day 1", d, "Day 2", d, "", d, None, d, None, d),
            (9, "X", "Y", "Z", d, "", "conventional", *sum(([s, d] for s in conv), []))]
    return spark.createDataFrame(rows, SCHED)


def test_event_filter(spark):
    names = [r.EventName for r in P.event_filter(_schedule(spark)).collect()]
    assert names == ["Bahrain Grand Prix", "Emilia Romagna Grand Prix"]
    assert P.event_filter(_schedule(spark), include_testing=True).count() == 3


def test_unpivot_keeps_order_and_drops_empty(spark):
    u = P.schedule_unpivot(_schedule(spark), ["EventName"]).filter(
        F.col("EventName") == "Emilia Romagna Grand Prix").orderBy("slot")
    assert [r.session for r in u.collect()] == ["Practice 1", "Qualifying", "Practice 2", "Sprint", "Race"]
    t = P.schedule_unpivot(_schedule(spark), ["EventName"]).filter(F.col("EventName") == "Pre-Season Test")
    assert t.count() == 2
    kept = P.schedule_unpivot(_schedule(spark), ["EventName"], drop_empty=False)
    assert kept.filter(F.col("EventName") == "Pre-Season Test").count() == 5


def test_nine_scope_modes(spark):
    s = _schedule(spark)
    one_e, two_e = ["Bahrain Grand Prix"], ["Bahrain Grand Prix", "Emilia Romagna Grand Prix"]
    one_s, two_s = ["Race"], ["Qualifying", "Race"]
    n = lambda e, ss: P.resolve_scope(s, e, ss).count()
    assert n(one_e, one_s) == 1 and n(two_e, one_s) == 2 and n(None, one_s) == 2
    assert n(one_e, two_s) == 2 and n(two_e, two_s) == 4 and n(None, two_s) == 4
    assert n(one_e, None) == 5 and n(two_e, None) == 10 and n(None, None) == 10
    # listed events are not checked against the schedule
    assert P.resolve_scope(s, ["Nowhere GP"], ["Race"]).count() == 1
    assert P.scope_mode(None, None) == "whole_season"
    assert P.scope_mode(one_e, two_s) == "one_event_multiple_sessions"


def test_enabled_sessions():
    assert P.enabled_sessions() == ["Race"]
    assert P.enabled_sessions(True, True, True) == ["Race", "Practice 1", "Practice 2", "Practice 3",
                                                    "Qualifying", "Sprint", "Sprint Shootout",
                                                    "Sprint Qualifying"]


def test_gap_plan_and_state_partial_loads_missing_three(spark):
    plan = spark.createDataFrame([("monza", "Race"), ("spa", "Race")], "event string, session string")
    expected = P.expected_files(plan, ["event", "session"])
    landed = spark.createDataFrame(
        [("monza", "Race", t) for t in ("results", "laps", "weather", "session_info")] +
        [("spa", "Race", t) for t in P.DATA_TYPES], "event string, session string, data_type string")
    gaps = P.gap_plan(expected, landed, ["event", "session"])
    assert sorted(r.data_type for r in gaps.collect()) == ["race_control_messages", "session_status",
                                                          "track_status"]
    st = {r.event: r for r in P.session_state(expected, landed, ["event", "session"]).collect()}
    assert st["monza"].state == "partial" and st["monza"].is_partial and len(st["monza"].missing) == 3
    assert st["spa"].state == "complete" and st["spa"].is_complete


def test_precedence_and_force_refresh(spark):
    cache = spark.createDataFrame([("a", "laps", 1), ("b", "laps", None)], "s string, t string, v int")
    storage = spark.createDataFrame([("a", "laps", 2), ("b", "laps", 2), ("c", "laps", 2)],
                                    "s string, t string, v int")
    origin = spark.createDataFrame([("a", "laps", 3), ("c", "laps", 3)], "s string, t string, v int")
    srcs = [(1, cache), (2, storage), (3, origin)]
    got = {r.s: r.v for r in P.resolve_precedence(srcs, ["s", "t"], F.col("v").isNotNull()).collect()}
    assert got == {"a": 1, "b": 2, "c": 2}
    forced = {r.s: r.v for r in P.resolve_precedence(srcs, ["s", "t"], force_rank=3).collect()}
    assert forced == {"a": 3, "c": 3}


def test_stamp_and_session_info(spark):
    s = _schedule(spark)
    plan = P.resolve_scope(s, ["Bahrain Grand Prix"], ["Race"])
    si = P.session_info_rows(s, plan).first()
    assert (si.location, si.round_number, si.session_5, si.session_name) == ("Sakhir", 1, "Race", "Race")
    info = spark.createDataFrame([("bahrain", "Race", "Bahrain Grand Prix", "Race", dt.datetime(2022, 3, 20))],
                                 "event string, session string, event_name string, "
                                 "session_name string, session_date timestamp_ntz")
    laps = spark.createDataFrame([("bahrain", "Race", 1.0), ("bahrain", "Race", 2.0)],
                                 "event string, session string, LapNumber double")
    st = P.stamp_sessions(laps, info, ["event", "session"]).collect()
    assert {r.EventName for r in st} == {"Bahrain Grand Prix"} and len(st) == 2


def test_overview_and_ledger(spark):
    laps = spark.createDataFrame([("m", "1"), ("m", "16"), ("m", "1")], "event string, DriverNumber string")
    res = spark.createDataFrame([("m",), ("s",)], "event string")
    ov = {r.event: r for r in P.session_overview({"laps": laps, "results": res}, ["event"]).collect()}
    assert ov["m"].lap_count == 3 and ov["m"].driver_count == 2 and ov["m"].has_results
    assert not ov["s"].has_laps and not ov["s"].has_weather
    t = dt.datetime
    ledger = spark.createDataFrame(
        [(2022, "m", "Race", t(2022, 1, 1), False, None, "boom"),
         (2022, "m", "Race", t(2022, 1, 2), True, ["laps"], None),
         (2022, "s", "Race", t(2022, 1, 1), True, ["laps"], None),
         (2022, "s", "Race", t(2022, 1, 3), False, None, "x"),
         (2022, "q", "Race", t(2022, 1, 1), False, None, "x")], P.LEDGER_SCHEMA)
    sm = P.ledger_summary(ledger).first()
    assert (sm.attempts, sm.successes, sm.successful_events) == (5, 2, 2)
    assert sm.success_rate == 40.0
    plan = spark.createDataFrame([("m", "Race"), ("s", "Race"), ("q", "Race"), ("n", "Race")],
                                 "event string, session string")
    skip = {r.event for r in P.plan_remaining(plan, ledger, ["event", "session"]).collect()}
    assert skip == {"q", "n"}
    retry = {r.event for r in P.plan_remaining(plan, ledger, ["event", "session"], "retry_failed").collect()}
    assert retry == {"s", "q"}


def test_precedence_keeps_every_row_of_the_winner(spark):
    a = spark.createDataFrame([("a", 1), ("a", 9), ("b", None)], "s string, v int")
    b = spark.createDataFrame([("a", 2), ("b", 2), ("b", 2), ("c", 2)], "s string, v int")
    srcs = [(1, a), (2, b)]
    got = sorted((r.s, r.v, r.source_rank) for r in P.resolve_precedence(srcs, ["s"], F.col("v").isNotNull()).collect())
    assert got == [("a", 1, 1), ("a", 9, 1), ("b", 2, 2), ("b", 2, 2), ("c", 2, 2)]
    only = P.resolve_precedence(srcs, ["s"], F.col("v").isNotNull(), force_rank=1)
    assert sorted((r.s, r.v) for r in only.collect()) == [("a", 1), ("a", 9)]


def test_season_tag_enabled_filter_and_cache_sizes(spark):
    df = spark.createDataFrame([("a", "Race"), ("a", "Practice 1"), ("b", "Sprint")],
                               "event string, session string")
    assert P.season_tag(df, 2024).first().Season == 2024
    got = {r.session for r in P.filter_enabled(df, P.enabled_sessions(include_sprint=True)).collect()}
    assert got == {"Race", "Sprint"}
    landed = spark.createDataFrame([("a", "laps", 1048576), ("a", "laps", 1048576),
                                    ("a", "results", 524288)],
                                   "event string, data_type string, length long")
    sizes = P.cache_sizes(landed, ["event"]).first().size_mb
    assert sizes == {"laps": 2.0, "results": 0.5}


def test_cluster_conf_and_dimensions(spark):
    from lapdeck.functions.domains import session_codes
    from lapdeck.session import cluster_conf
    conf = cluster_conf(100 * 2**40)  # 100 TiB: every partition of the stated size
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert int(cluster_conf(10 * 2**30)["spark.sql.shuffle.partitions"]) == 200
    codes = {r.code: r.session_name for r in session_codes(spark).collect()}
    assert codes["R"] == "Race" and codes["FP2"] == "Practice 2"
