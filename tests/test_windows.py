"""Event time, lateness, dedup and accumulating panes (E1-E13, A1-A9; FIXTURES.md F4)."""
from pyspark.sql import functions as F

from telemetra.constants import REFERENCE_SPEC
from telemetra.operators.decode import decode_observations, ok_observations
from telemetra.operators.windows import late_firing_report, plain_window_results, windowed_results
from conftest import feed, obs

A = dict(thing="a", metric="temperature")
B = dict(thing="b", metric="temperature")
F4 = [
    obs(1000, 1, 1.0, **A),     # 1 on time, window 0
    obs(3000, 2, 2.0, **A),     # 2 on time
    obs(3000, 2, 99.0, **A),    # 3 duplicate (ignored)
    obs(12000, 3, 3.0, **A),    # 4 on time, window 10000; window 0 fires
    obs(4000, 1, 5.0, **B),     # B: first record of window 0 after it fired -> fire_index 1, not late
    obs(5000, 4, 4.0, **A),     # 5 late accepted -> window 0 pane 2
    obs(5000, 4, 4.0, **A),     # 6 duplicate, no firing
    obs(27000, 5, 5.0, **A),    # 7 on time, window 20000; window 10000 fires
    obs(9000, 6, 6.0, **A),     # 8 late accepted -> window 0 pane 3
    obs(27001, 7, 7.0, **A),    # 9 on time; window 0 expires
    obs(9500, 8, 8.0, **A),     # 10 too late
    obs(9000, 6, 6.0, **A),     # 11 too-late duplicate -> still late output
]


def run(spark, records, flush=True):
    ok = ok_observations(decode_observations(feed(spark, records)))
    return windowed_results(ok, REFERENCE_SPEC, flush=flush)


def test_f4_panes(spark):
    results, late = run(spark, F4)
    rows = results.orderBy("datastream_id", "window_start", "fire_index").collect()
    got = [(r["datastream_id"], r["window_start"], r["fire_index"], r["count"], r["is_late_firing"])
           for r in rows]
    assert got == [
        ("a:temperature", 0, 1, 2, False),
        ("a:temperature", 0, 2, 3, True),
        ("a:temperature", 0, 3, 4, True),
        ("a:temperature", 10000, 1, 1, False),
        ("a:temperature", 20000, 1, 2, False),
        ("b:temperature", 0, 1, 1, False),
    ]
    w0 = [r for r in rows if r["datastream_id"] == "a:temperature" and r["window_start"] == 0]
    assert [r["min_value"] for r in w0] == [1.0, 1.0, 1.0]
    assert [r["max_value"] for r in w0] == [2.0, 4.0, 6.0]
    assert w0[2]["average"] == (1 + 2 + 4 + 6) / 4
    assert w0[0]["window"] == "00:00:00 - 00:00:10"
    # pane 1 is emitted when the watermark passes (arrival of row 4), re-firings at their rows
    assert [r["result_time"] for r in w0] == [3000, 5000, 8000]
    lt = late.orderBy("seq").collect()
    assert [(r["seq"], r["late_by_sec"]) for r in lt] == [(6, 0.0), (8, 0.0)]


def test_late_by_seconds_positive(spark):
    # a record arriving 40 s after its window closed for good
    recs = [obs(1000, 1, **A), obs(60000, 2, **A), obs(2000, 3, **A)]
    ok = ok_observations(decode_observations(feed(spark, recs, step_ms=20000)))
    _, late = windowed_results(ok, REFERENCE_SPEC)
    (r,) = late.collect()
    assert r["seq"] == 3 and r["late_by_sec"] == 15.0   # arrival 40000 - (10000 + 15000)


def test_no_flush_keeps_open_windows(spark):
    results, _ = run(spark, F4, flush=False)
    ws = {(r["datastream_id"], r["window_start"]) for r in results.collect()}
    assert ("a:temperature", 20000) not in ws and ("a:temperature", 10000) in ws


def test_report_lines(spark):
    results, _ = run(spark, F4)
    lines = [r["line"] for r in late_firing_report(results).orderBy("fire_index").collect()]
    assert lines[0] == "[LATE FIRING] key=a:temperature metric=temperature window=00:00:00 - 00:00:10 fire_index=2"


def test_counter_ties_and_state_alarm(spark):
    C = dict(thing="c", metric="water", sensor_type="counter")
    S = dict(thing="s", metric="door", sensor_type="state")
    L = dict(thing="l", metric="move", sensor_type="alarm")
    recs = [obs(1000, 1, 10.0, **C), obs(1000, 2, 20.0, **C), obs(2000, 3, 30.0, **C),
            obs(2000, 4, 25.0, **C),
            obs(1000, 1, "ON", **S), obs(3000, 2, "OFF", **S), obs(2000, 3, "ON", **S),
            obs(1000, 1, True, **L), obs(2000, 2, False, **L), obs(2000, 3, False, **L)]
    res = {r["datastream_id"]: r for r in plain_window_results(
        ok_observations(decode_observations(feed(spark, recs))), 10000).collect()}
    c = res["c:water"]
    assert (c["first_value"], c["last_value"], c["delta"]) == (10.0, 25.0, 15.0)
    s = res["s:door"]
    assert (s["on_count"], s["off_count"], s["distinct_counts"], s["last_state"]) == (2, 1, 2, "OFF")
    a = res["l:move"]
    assert (a["true_count"], a["false_count"], a["triggered"], a["alarm_last_value"]) == (1, 2, True, False)
    assert abs(a["true_ratio"] - 1 / 3) < 1e-12 and a["distinct_counts"] == 2


def test_invariants_on_fixture(spark):
    from conftest import SF_SMALL
    from telemetra.constants import FIXTURE_SPEC
    from telemetra.operators.eventtime import classify_lateness
    from telemetra.plans.pipeline import fixture_ok
    ok = fixture_ok(spark, SF_SMALL).cache()
    cls = classify_lateness(ok, FIXTURE_SPEC)
    counts = {r["lateness"]: r["count"] for r in cls.groupBy("lateness").count().collect()}
    assert counts == {"on_time": 922, "late_accepted": 6, "too_late": 10}       # FIXTURES.md F5
    results, late = windowed_results(ok, FIXTURE_SPEC)
    assert results.count() == 671 and late.count() == 10
    assert results.select("datastream_id", "window_start").distinct().count() == 668
    # the last pane of every window equals a plain aggregate over its accepted rows, column by column
    accepted = cls.filter("lateness <> 'too_late'").drop("window_start", "window_end")
    columns = [c for c in results.columns if c not in ("fire_index", "is_late_firing", "result_time", "latency",
                                                       "end_to_end_latency")]
    last = (results.groupBy("datastream_id", "window_start").agg(F.max("fire_index").alias("fire_index"))
            .join(results, ["datastream_id", "window_start", "fire_index"]))
    key = lambda r: (r["datastream_id"], r["window_start"])
    want = {key(r): r for r in plain_window_results(accepted, FIXTURE_SPEC.window_ms).collect()}
    got = last.collect()
    assert len(got) == len(want) == 668 and sum(r["count"] for r in got) == 922 + 6 - 17   # less duplicates
    for r in got:
        for c in columns:
            a, b = r[c], want[key(r)][c]
            assert a == b or abs(a - b) < 1e-9, c
    # repartitioning the input leaves the output unchanged
    again, _ = windowed_results(ok.repartition(3), FIXTURE_SPEC)
    assert again.exceptAll(results).count() == 0 and results.exceptAll(again).count() == 0
