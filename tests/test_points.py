"""Consumers: hygiene (S6), unwrap (S7), gate (S9), points (R1-R7) - FIXTURES.md F7."""
import json

from pyspark.sql import functions as F

from telemetra.fixtures import topics as TP
from telemetra.operators import points as P
from telemetra.operators.windows import plain_window_results
from telemetra.session import materialize


def msgs(spark, payloads, col="value", binary=False):
    rows = [(bytearray(p) if binary and p is not None else p, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, f"{col} {'binary' if binary else 'string'}, i bigint")


def test_payload_hygiene(spark):
    good = b'{"a": 1}'
    payloads = [None, b"", b"\x00" + good, b"  \n ", b'{"a": "x\xffy"}', b"not json", good]
    out = P.payload_hygiene(msgs(spark, payloads, binary=True)).orderBy("i").collect()
    assert [r["i"] for r in out] == [4, 6]
    assert out[0]["text"] == '{"a": "xy"}'


def test_unwrap_and_dlq_points(spark):
    inner = json.dumps({"error": "invalid_metric", "timestamp": "t"})
    payloads = [inner, json.dumps(inner), json.dumps({"timestamp": "t"}), "not json"]
    m = msgs(spark, payloads).withColumn("timestamp_ms", F.col("i") * 10)
    pts = P.dlq_points(m).orderBy("time_ms").collect()
    assert [p["reason"] for p in pts] == ["invalid_metric", "invalid_metric", "unknown"]
    assert pts[0]["stage"] == "flink_decoder" and len(pts[0]["dlq_id"]) == 64


def test_late_points(spark):
    base = {"datastream_id": "d", "metric": "m", "seq": 3, "event_time": "2026-03-09T12:00:00+00:00",
            "late_by_sec": 1.5}
    payloads = [json.dumps(base), json.dumps(json.dumps(base)),
                json.dumps({k: v for k, v in base.items() if k not in ("metric", "seq")}),
                json.dumps({k: v for k, v in base.items() if k != "event_time"})]
    pts = P.late_points(msgs(spark, payloads)).collect()
    assert len(pts) == 3
    assert sorted(p["metric"] for p in pts) == ["m", "m", "unknown"]
    assert sorted(p["seq"] for p in pts) == ["3", "3", "NA"]


def test_gate_and_typed_points(spark):
    common = {"datastream_id": "d", "window": "w", "count": 4, "metric": "m", "window_start": 0,
              "window_end": 10000, "result_time": 1, "max_event_time": 1, "max_publish_time": 1,
              "latency": 0, "end_to_end_latency": 0, "fire_index": 2}
    analog = {**common, "sensor_type": "analog", "min_value": 1, "max_value": 2, "average": 1.5}
    payloads = [json.dumps(analog),
                json.dumps({k: v for k, v in analog.items() if k != "count"}),
                json.dumps({k: v for k, v in analog.items() if k != "fire_index"}),
                json.dumps({**analog, "average": "abc"}),
                json.dumps({**common, "sensor_type": "state", "on_count": 1, "off_count": 3,
                            "distinct_counts": 2})]
    g = P.required_fields_gate(msgs(spark, payloads))
    assert g.count() == 4
    assert sorted(r["fire_index"] for r in g.collect()) == [1, 2, 2, 2]
    a = P.processed_points(g, "analog").collect()
    assert len(a) == 2 and a[0]["throughput"] == 0.4 and a[0]["time_ms"] == 10000
    assert P.processed_points(g, "state").first()["off_count"] == 3


def test_upsert_last_write_wins(spark):
    df = spark.createDataFrame([("k", 1, 1.0), ("k", 2, 2.0), ("j", 1, 5.0)], "id string, o int, v double")
    out = {r["id"]: r["v"] for r in P.upsert_latest(df, ["id"], ["o"]).collect()}
    assert out == {"k": 2.0, "j": 5.0}


def test_detector_gate_feeds_the_detector(spark):
    from conftest import SF_SMALL
    from telemetra.constants import FIXTURE_SPEC
    from telemetra.operators import detector as DT
    from telemetra.plans.pipeline import hourly_results
    from telemetra.fixtures.topics import results_topic
    res = hourly_results(spark, SF_SMALL).cache()
    clean = P.payload_hygiene(results_topic(res, FIXTURE_SPEC.window_ms), "value")
    via_json = DT.features(P.detector_gate(clean))
    keys = ["datastream_id", "window_start", "fire_index"]
    direct = DT.features(res).join(via_json.select(*keys), keys, "left_semi")
    cols = keys + ["branch", "time", "day_of_week"] + [f"f{i}" for i in range(DT.MAX_FEATURES)]
    assert via_json.count() > 0
    assert via_json.select(*cols).exceptAll(direct.select(*cols)).count() == 0
    assert direct.select(*cols).exceptAll(via_json.select(*cols)).count() == 0
    # the smaller gate: a record without window_end, or an analog one without average, is skipped
    bad = [json.dumps({"datastream_id": "d", "metric": "m", "sensor_type": "state", "distinct_counts": 1}),
           json.dumps({"datastream_id": "d", "metric": "m", "sensor_type": "analog", "window_end": 5,
                       "min_value": 1, "max_value": 2}),
           json.dumps({"datastream_id": "d", "metric": "m", "sensor_type": "state", "window_end": 5,
                       "distinct_counts": 2})]
    got = P.detector_gate(msgs(spark, bad, col="text")).collect()
    assert len(got) == 1 and got[0]["distinct_counts"] == 2 and got[0]["fire_index"] == 1


def test_dlq_and_late_messages_that_are_no_objects_or_lack_keys(spark):
    import json
    from telemetra.operators.points import dlq_points, late_points
    texts = ["5", "[1]", "true", "null", "not json", json.dumps({"size": 1}), json.dumps({"error": "x"})]
    df = spark.createDataFrame([(t, 7) for t in texts], "value string, timestamp_ms bigint")
    assert sorted(r["reason"] for r in dlq_points(df).collect()) == ["unknown", "x"]
    rec = {"datastream_id": "d", "metric": "m", "seq": 3, "event_time": "2026-03-09T12:00:00", "late_by_sec": 1.5}
    drop = lambda *k: json.dumps({a: b for a, b in rec.items() if a not in k})
    texts = ["5", drop(), drop("late_by_sec", "metric"), json.dumps({**rec, "late_by_sec": "abc"}),
             json.dumps({**rec, "late_by_sec": None}), json.dumps({**rec, "seq": None}), drop("seq"), drop("event_time")]
    df = spark.createDataFrame([(t, 7) for t in texts], "value string, timestamp_ms bigint")
    got = sorted((r["metric"], r["seq"], r["late_by_seconds"]) for r in late_points(df).collect())
    assert got == [("m", "3", 1.5), ("m", "NA", 1.5), ("m", "None", 1.5), ("unknown", "3", 0.0)]


def test_detector_gate_over_damaged_results_compiles(spark):
    """The gate's stage is compiled, not interpreted row by row (Spark logs a failed compilation and goes on)."""
    row = "thing_id string, datastream_id string, metric string, sensor_type string, seq bigint, event_ms bigint, " \
          "publish_ms bigint, arrival_ms bigint, arrival_seq bigint, num double, sval string, bval boolean"
    ok = spark.createDataFrame([("t-0", "t-0:temperature", "temperature", "analog", i, i * 1000, i * 1000, i * 1000, i,
                                 1.0, "1.0", True) for i in range(0, 180, 2)], row)
    results = materialize(plain_window_results(ok, 10_000))
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        gated = P.detector_gate(P.payload_hygiene(TP.results_topic(results, 10_000), "value")).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    # of 18 windows, 5 of each 9 are damaged beyond reading: null, empty, led by NUL, blank, not JSON
    assert sorted(r["window_start"] // 10_000 for r in gated) == [i for i in range(18) if (i + 1) % 9 in (0, 5, 7, 8)]
    assert {r["average"] for r in gated} == {1.0}
