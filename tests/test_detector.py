"""Detector: rules, features, half-space trees, ADWIN and the sequential driver."""
import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from telemetra.operators import detector as DT, sequential as SQ
from telemetra.operators import adwin
from telemetra.operators.hst import forest, path_keys_batch
from plain_detector import Adwin, HalfSpaceTrees, Scaler, paths, run

HOUR = 3_600_000
SCHEMA = ("datastream_id string, metric string, sensor_type string, window_start bigint, window_end bigint, "
          "result_time bigint, fire_index int, min_value double, max_value double, average double, "
          "delta double, distinct_counts bigint, true_ratio double, true_count bigint")


def result(ds, metric, st, i, **kw):
    ws = i * HOUR
    row = dict(datastream_id=ds, metric=metric, sensor_type=st, window_start=ws, window_end=ws + HOUR,
               result_time=ws + HOUR + 1, fire_index=1, min_value=None, max_value=None, average=None,
               delta=None, distinct_counts=None, true_ratio=None, true_count=None)
    row.update(kw)
    return row


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_fault_rules_and_smoke(spark):
    rows = [result("co2a", "co2", "analog", 0, min_value=1.0, max_value=10000.0, average=5.0),
            result("co2b", "co2", "analog", 0, min_value=1.0, max_value=10000.5, average=5.0),
            result("t", "temperature", "analog", 0, min_value=-60.0, max_value=130.0, average=5.0),
            result("s0", "smoke", "alarm", 0, true_ratio=0.0, true_count=0),
            result("s1", "smoke", "alarm", 0, true_ratio=0.5, true_count=1),
            result("w", "window", "alarm", 0, true_ratio=0.5, true_count=1)]
    f = {r["datastream_id"]: r for r in DT.features(frame(spark, rows)).collect()}
    assert f["co2a"]["branch"] == "analog" and f["co2b"]["branch"] == "fault"
    assert f["co2b"]["anomaly_value"] == 10000.5
    assert f["t"]["anomaly_value"] == -60.0        # low side checked first
    assert f["s1"]["branch"] == "smoke" and "s0" not in f and "w" not in f
    assert f["t"]["time"] == 1 and f["t"]["day_of_week"] == 3   # 1970-01-01 01:00 was a Thursday


def test_tree_shapes_and_walk():
    fr = forest("analog")
    assert fr.n_trees == 25 and len(fr.feats[0]) == 63 and fr.n_nodes == 127
    assert all(-3 * 0.7 <= t <= 3 * 0.7 for t in fr.thrs[0][:1])
    z = np.array([0.1, -0.2, 0.3, 0.0, 1.0, -1.0])
    p = paths(fr, z)
    assert p.shape == (25, 7) and (p[:, 0] == 0).all() and (p[:, -1] >= 63).all()
    flat = path_keys_batch(np.array(["analog"]), [z])[0]
    assert (flat.reshape(25, 7) == p + np.arange(25)[:, None] * 127).all()


def test_hst_first_window_scores_zero_and_spike_scores_high():
    rng = np.random.default_rng(0)
    m = HalfSpaceTrees(forest("state"))
    scores = []
    for i in range(400):
        z = rng.normal(0, 0.3, 3)
        scores.append(m.score_one(z))
        m.learn_one(z)
    assert scores[:100] == [0.0] * 100
    assert 0 < np.mean(scores[100:]) < 0.7
    assert m.score_one(np.array([2.9, -2.9, 2.9])) > np.mean(scores[100:])


def test_adwin_detects_level_shift_only():
    rng = np.random.default_rng(1)
    a = Adwin()
    hits = []
    for i in range(600):
        a.update(rng.normal(0.2 if i < 300 else 0.8, 0.05))
        if a.drift_detected:
            hits.append(i)
    assert hits and 300 <= hits[0] < 360
    b = Adwin()
    assert not any((b.update(x), b.drift_detected)[1] for x in rng.normal(0.5, 0.05, 600))


def level_stream(n_each=300):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(2 * n_each):
        level = 10.0 if i < n_each else 60.0
        v = level + rng.normal(0, 1)
        rows.append(result("d", "humidity", "analog", i, min_value=v - 1, max_value=v + 1, average=v))
    return rows


def test_relational_and_sequential_agree_before_drift(spark):
    feat = DT.features(frame(spark, level_stream()))
    rel = {(r["window_start"], r["n"]): r["anomaly_score"]
           for r in DT.hst_scores(DT.zscores(feat)).collect()}
    seq = SQ.detect(feat, emit_scores=True).filter("kind = 'score' AND reset_count = 0").collect()
    assert len(seq) >= 100
    assert all(abs(rel[(r["window_start"], r["n"])] - r["anomaly_score"]) < 1e-9 for r in seq)


def test_small_spread_far_from_zero_is_scored(spark):
    rows = [result("v", "voltage", "analog", i, min_value=230 - 0.005, max_value=230 + 0.005,
                   average=230 + 0.005 * (-1) ** i) for i in range(40)]
    rows += [result("c", "voltage", "analog", i, min_value=1.7, max_value=1.7, average=1.7) for i in range(40)]
    z = DT.zscores(DT.features(frame(spark, rows))).collect()
    late = [r["zs"][0] for r in z if r["datastream_id"] == "v" and r["n"] > 10]
    assert all(0.9 < abs(v) < 1.2 for v in late)
    assert all(v == 0 for r in z if r["datastream_id"] == "c" for v in r["zs"][:4])
    s = Scaler(1)
    for i in range(30):
        s.learn(np.array([230 + 0.005 * (-1) ** i]))
    assert abs(s.transform(np.array([230.005]))[0] - 1) < 1e-3


def test_drift_resets_model(spark):
    feat = DT.features(frame(spark, level_stream()))
    ev = SQ.detect(feat, emit_state=True).collect()
    drifts = [e for e in ev if e["kind"] == "drift"]
    assert drifts, "a level shift must be reported"
    assert drifts[0]["detector"] == "ADWIN" and drifts[0]["reset_count"] == 1
    assert drifts[0]["count_before_reset"] >= 30
    state = [e for e in ev if e["kind"] == "state"]
    assert max(s["reset_count"] for s in state) == len(drifts)
    # the drifting record never raises an anomaly: count is 0 after the reset
    for d in drifts:
        assert not [e for e in ev if e["kind"] == "anomaly" and e["time_ms"] == d["time_ms"]
                    and e["anomaly_type"] == "statistical"]


def test_resume_from_snapshot_equals_one_run(spark):
    feat = DT.features(frame(spark, level_stream())).cache()
    cut = 250 * HOUR
    cols = ["kind", "time_ms", "anomaly_score", "drift_value", "count_before_reset", "reset_count"]
    whole = SQ.detect(feat).filter(F.col("window_start") >= cut).select(*cols)
    first = SQ.detect(feat.filter(F.col("window_start") < cut), emit_state=True)
    snaps = SQ.newest_snapshots(first)
    second = SQ.detect(feat.filter(F.col("window_start") >= cut), resume=snaps).select(*cols)
    assert whole.count() > 0
    assert whole.exceptAll(second).count() == 0 and second.exceptAll(whole).count() == 0


def test_load_repairs():
    import pickle
    assert SQ.load(b"not a pickle")["count"] == 0 and SQ.load(None)["count"] == 0
    state = SQ.fresh_state()
    SQ.start_model(state, SQ.CODES["analog"])
    state["count"] = 7
    d = pickle.loads(SQ.dump(state))
    del d["cooldown"], d["adwin"], d["scaler"], d["trees"]["ref"]
    back = SQ.load(pickle.dumps(d))
    assert back["count"] == 7 and back["cooldown"] == 0 and back["scaler"]["n"] == 0 and not back["trees"]["ref"].any()
    assert SQ.load(pickle.dumps({**d, "format": 99}))["count"] == 0


def test_snapshot_is_small_and_plain():
    import pickletools
    state = SQ.fresh_state()
    x = np.random.default_rng(0).normal(0, 1, (450, SQ.MAX_FEATURES))
    to = SQ.Settings(2.0, False, False, True)
    codes = np.zeros(450, dtype=np.int64)
    state = SQ.advance(state, "d", codes, x, 0, 450, to, SQ.Found())
    blob = SQ.dump(state)
    assert len(blob) < 30_000
    assert not any("telemetra" in str(arg) for _, arg, _ in pickletools.genops(blob))
    to.emit_scores = True
    told = []
    for start in (state, SQ.load(blob)):
        found = SQ.Found()
        SQ.advance(start, "d", codes[:300], x[::-1], 0, 300, to, found)
        told.append([tuple(map(list, p)) for p in found.parts])
    assert told[0] == told[1]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.lists(st.integers(1, 300), min_size=1, max_size=6), st.floats(0, 1))
def test_adwin_arrays_equal_values_one_by_one(seed, sizes, shift):
    """In pieces of any length, the first change is found at the same value."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0.3, 0.1, sum(sizes))
    x[len(x) // 2:] += shift
    plain = Adwin()
    want = next((i for i, v in enumerate(x) if (plain.update(v), plain.drift_detected)[1]), -1)
    state, at, got = adwin.fresh(), 0, -1
    for n in sizes:
        hit, state = adwin.advance(state, x[at:at + n])
        if hit >= 0:
            got = at + hit
            break
        at += n
    assert got == want


def test_bucket_borders_are_those_of_the_histogram():
    plain, rng = Adwin(delta=1e-300), np.random.default_rng(0)
    for n in range(1, 700):
        plain.update(rng.normal(0.5, 0.01))
        sizes = [2 ** i for i in range(len(plain.rows) - 1, -1, -1) for _ in plain.rows[i]]
        assert adwin.bucket_borders(n).tolist() == np.cumsum(sizes)[:-1].tolist()


def mixed_streams(n=900, seed=4):
    """Streams of every branch with levels, faults, smoke, changes of branch and repeated values."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        level = 20.0 + 30 * (i // 260 % 2)
        v = level + rng.normal(0, 1)
        rows.append(result("a", "humidity", "analog", i, min_value=v - rng.random(), max_value=v + 1, average=v))
        rows.append(result("c", "water", "counter", i, delta=float(rng.integers(0, 5) * (1 + i // 300))))
        rows.append(result("s", "door", "state", i, distinct_counts=1 + int(i % 50 == 0)))
        rows.append(result("m", "move", "alarm", i, true_ratio=float(rng.random() ** (1 + i // 400)), true_count=i % 4))
        mixed = i % 97 < 40
        rows.append(result("x", "co2", "analog" if mixed else "counter", i, min_value=-1.0 if i % 31 == 0 else 1.0, max_value=9.0,
                           average=5.0 + i % 3, delta=float(i % 5)))
        rows.append(result("k", "smoke", "alarm", i, true_ratio=0.5, true_count=i % 3))
    rows.append(result("f", "co2", "analog", 0, min_value=-1.0, max_value=2.0, average=0.0))
    return rows


def events_of(df):
    """Events with scores rounded, by stream; drift rows carry the drift value and the count before it."""
    out = {}
    for r in df.filter("kind IN ('anomaly', 'drift')").collect():
        score = r["drift_value"] if r["kind"] == "drift" else r["anomaly_score"]
        n = r["count_before_reset"] if r["kind"] == "drift" else r["n"]
        out.setdefault(r["datastream_id"], []).append((r["time_ms"], r["kind"], round(score, 7), n, r["anomaly_type"]))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_arrays_equal_the_plain_detector(spark):
    """Every event and final count of streams with drifts, faults, smoke and branch changes."""
    feat = DT.features(frame(spark, mixed_streams())).cache()
    got = SQ.detect(feat, threshold=0.6, emit_state=True).cache()
    by_stream = {}
    for r in feat.orderBy("datastream_id", *DT.ORDER).collect():
        by_stream.setdefault(r["datastream_id"], []).append(r)
    want, ends = {}, {}
    for k, rows in by_stream.items():
        branch = {r["window_end"]: r["branch"] for r in rows}
        events, ends[k] = run(rows, 0.6)
        kind = {"fault": "hardware_fault", "analog": "statistical", "counter": "statistical"}
        told = [(t, e, round(s, 7), n, kind.get(branch[t]) if e == "anomaly" else None) for e, t, s, n, _ in events]
        want.update({k: sorted(told, key=str)} if told else {})
    assert events_of(got) == want
    assert sum(e[1] == "drift" for v in want.values() for e in v) > 8
    last = got.filter("kind = 'state'").groupBy("datastream_id").agg(F.max_by("n", "version"), F.max_by("reset_count", "version"))
    assert {r[0]: (r[1], r[2]) for r in last.collect()} == ends


def test_snapshots_on_progress_drift_and_end(spark):
    """One every 2,000 rows of a stream, one per drift, one at its end; the newest is resumed."""
    rows = [result("k", "smoke", "alarm", i, true_ratio=0.5, true_count=1) for i in range(4500)]
    rows += [result("e", "smoke", "alarm", i, true_ratio=0.5, true_count=1) for i in range(4000)]
    feat = DT.features(frame(spark, rows + level_stream()))
    ev = SQ.detect(feat, emit_state=True).cache()
    got = {r[0]: r[1] for r in ev.filter("kind = 'state'").groupBy("datastream_id").count().collect()}
    assert got == {"k": 3, "e": 2, "d": 1 + ev.filter("kind = 'drift'").count()}
    at = [(r["version"], r["n"]) for r in ev.filter("kind = 'state' AND datastream_id = 'k'").orderBy("version").collect()]
    assert at == [(1, 2000), (2, 4000), (3, 4500)]
    newest = {r[0]: SQ.load(r[1])["seen"] for r in SQ.newest_snapshots(ev).collect()}
    assert newest == {"k": 4500, "e": 4000, "d": 600}


def test_scores_without_drift_equal_the_relational_ones(spark):
    """M8, M9 carried from chunk to chunk equal prefix sums and block masses, whatever the chunk."""
    feat = DT.features(frame(spark, [r for r in mixed_streams(500) if r["datastream_id"] != "x"])).cache()
    want = {(r["datastream_id"], r["n"]): r["anomaly_score"] for r in DT.hst_scores(DT.zscores(feat)).collect()}
    got = {(r["datastream_id"], r["n"]): r["anomaly_score"]
           for r in SQ.detect(feat, emit_scores=True, drift=False).filter("kind = 'score'").collect()}
    assert len(want) == len(got) == 4 * 500
    assert all(abs(got[k] - v) < 1e-8 for k, v in want.items())


def test_branch_change_keeps_count(spark):
    rows = [result("m", "x", "analog", i, min_value=1.0 + i % 7, max_value=3.0 + i % 5, average=2.0 + i % 3) for i in range(160)]
    rows[120] = result("m", "x", "counter", 120, delta=4.0)
    ev = SQ.detect(DT.features(frame(spark, rows)), emit_state=True).collect()
    assert [max((e for e in ev if e["kind"] == "state"), key=lambda e: e["version"])["n"]] == [160 - sum(
        e["count_before_reset"] for e in ev if e["kind"] == "drift")]
