"""Decode, validation reasons in order and DLQ records (V1-V9, FIXTURES.md F3)."""
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from telemetra.operators.decode import decode_observations, dlq_reason_counts, dlq_records, ok_observations
from conftest import feed, obs


def reasons(spark, records):
    d = decode_observations(feed(spark, records))
    return [r["error"] for r in d.orderBy("arrival_seq").collect()]


def test_valid_rows_per_type(spark):
    recs = [obs(1000, value=21.5), obs(1000, value=7, sensor_type="counter", metric="water"),
            obs(1000, value="ON", sensor_type="state", metric="door"),
            obs(1000, value=True, sensor_type="alarm", metric="move")]
    assert reasons(spark, recs) == [None] * 4
    ok = ok_observations(decode_observations(feed(spark, recs))).orderBy("arrival_seq").collect()
    assert [r["value_kind"] for r in ok] == ["number", "number", "string", "bool"]
    assert ok[0]["event_ms"] == 1000 and ok[0]["num"] == 21.5


def test_each_reason(spark):
    base = obs(1000)
    cases = [
        ({**base, "thing_id": " \t"}, "invalid_thing_id"),
        ({**base, "datastream_id": "   "}, "invalid_datastream_id"),
        ({**base, "metric": "   "}, "invalid_metric"),
        ({**base, "sensor_type": "pressure"}, "invalid_sensor_type"),
        ({**base, "seq": True}, "invalid_seq"),
        ({**base, "seq": 1.5}, "invalid_seq"),
        ({**base, "event_time": "2026-99-99 broken-time"}, "invalid_event_time"),
        ({**base, "value": None}, "invalid_value"),
        ({**base, "publish_time": ""}, "invalid_publish_time"),
        ({**base, "value": True}, "invalid_analog_value"),
        ({**base, "sensor_type": "counter", "value": "12"}, "invalid_counter_value"),
        ({**base, "sensor_type": "state", "value": "on"}, "invalid_state_value"),
        ({**base, "sensor_type": "alarm", "value": 1}, "invalid_alarm_value"),
        ("totally_invalid_avro_garbage_123456789", "decode_failed"),
        ("[1, 2]", "decode_failed"),
    ]
    assert reasons(spark, [c for c, _ in cases]) == [r for _, r in cases]


def test_first_failing_check_wins(spark):
    recs = [{**obs(1000), "metric": "  ", "event_time": "bad"},
            {**obs(1000), "value": None, "publish_time": "bad"}]
    assert reasons(spark, recs) == ["invalid_metric", "invalid_value"]


def test_dlq_records_shapes(spark):
    recs = ["x" * 10, {**obs(1000), "thing_id": "  ", "metric": "m" * 150}]
    d = decode_observations(feed(spark, recs))
    rows = dlq_records(d).orderBy("arrival_seq").collect()
    assert rows[0]["error"] == "decode_failed" and rows[0]["size_bytes"] == 10
    assert rows[0]["thing_id"] is None
    assert rows[1]["error"] == "invalid_thing_id" and len(rows[1]["metric"]) == 100
    counts = {r["reason"]: r["dlq_count"] for r in dlq_reason_counts(dlq_records(d)).collect()}
    assert counts == {"decode_failed": 1, "invalid_thing_id": 1}


def test_ok_plus_dlq_is_input(spark):
    from conftest import SF_SMALL
    from telemetra.plans.pipeline import fixture_feed
    raw = fixture_feed(spark, SF_SMALL)
    d = decode_observations(raw)
    n = raw.count()
    assert ok_observations(d).count() + dlq_records(d).count() == n
    assert d.filter(F.col("error").isNull()).count() == 938   # FIXTURES.md F5, sf0.001


def test_broken_json_and_wire_seq(spark):
    """Only a text that is one JSON object is decoded; seq is a 32-bit integer token."""
    import json
    good = json.dumps(obs(1000))
    with_seq = lambda t: good.replace('"seq": 1,', f'"seq": {t},')
    cases = {good: None, "  " + good + "\n": None, good[:-1]: "decode_failed", "{": "decode_failed",
             good + " trailing": "decode_failed", good + "} x": "decode_failed", good + "], x": "decode_failed",
             good + good: "decode_failed", good + ',"b":2': "decode_failed", f"[{good}]": "decode_failed",
             "5": "decode_failed", "null": "decode_failed", "": "decode_failed",
             with_seq("2.0"): "invalid_seq", with_seq("1e3"): "invalid_seq", with_seq(str(1 << 40)): "invalid_seq",
             with_seq('"1"'): "invalid_seq", with_seq(str((1 << 31) - 1)): None, with_seq(str(-(1 << 31))): None,
             good[:-1] + ', "extra": {"a": {"b": 1}}}': None}
    got = decode_observations(feed(spark, list(cases))).orderBy("arrival_seq").collect()
    assert [r["error"] for r in got] == list(cases.values())


def test_time_is_utc_in_any_session_zone(spark):
    from telemetra.functions.timeparse import hms_label, iso_to_millis, millis_to_iso
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("America/New_York", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.createDataFrame([("1970-01-01T00:00:01",), ("1970-01-02",), ("1970-01-01 02:30:00,5",),
                                        ("1970-01-01T02:00:00+0200",), ("1970-01-01T02:00:00+02:00",)], "t string")
            ms = [r[0] for r in df.select(iso_to_millis(F.col("t"))).collect()]
            assert ms == [1000, 86_400_000, 9_000_500, 0, 0]
            one = spark.range(1).select(millis_to_iso(F.lit(-1).cast("long")), hms_label(F.lit(3_600_000), F.lit(86_399_000))).first()
            assert list(one) == ["1969-12-31T23:59:59.999+00:00", "01:00:00 - 23:59:59"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


RECORD = {"thing_id": "t", "datastream_id": "t:x", "metric": "x", "sensor_type": "analog", "seq": 4,
          "event_time": "1970-01-01T00:00:01Z", "value": 2.5, "publish_time": "1970-01-01T00:00:02Z"}


def avro(spark, payloads):
    df = spark.createDataFrame([(None if p is None else bytearray(p), i) for i, p in enumerate(payloads)], "payload binary, arrival_seq bigint")
    return decode_observations(df, wire="avro").orderBy("arrival_seq").collect()


def test_avro_members_and_checks(spark):
    """All four members of the value's union, and the same checks as for JSON."""
    from telemetra.fixtures.avro_feed import encode, varint
    state, alarm = {"sensor_type": "state", "value": "ON"}, {"sensor_type": "alarm", "value": False}
    got = avro(spark, [encode(RECORD), encode({**RECORD, **state}), encode({**RECORD, **alarm}), encode({**RECORD, "value": -70}),
                       encode({**RECORD, "value": "warm"}), encode({**RECORD, "seq": 1 << 40}), encode({**RECORD, "seq": -3}),
                       encode({**RECORD, "thing_id": " "}), encode({**RECORD, "metric": "\u00e9\u4e2d" * 90}), encode(RECORD) + b"more"])
    assert [(r["error"], r["value_kind"], r["num"]) for r in got] == [
        (None, "number", 2.5), (None, "string", None), (None, "bool", 0.0), (None, "number", -70.0),
        ("invalid_analog_value", "string", None), ("invalid_seq", "number", 2.5), (None, "number", 2.5),
        ("invalid_thing_id", "number", 2.5), (None, "number", 2.5), (None, "number", 2.5)]
    assert [r["sval"] for r in got[:4]] == ["2.5", "ON", "False", "-70"] and [r["bval"] for r in got[:4]] == [True, True, False, True]
    assert got[6]["seq"] == -3 and got[8]["metric"] == "\u00e9\u4e2d" * 90 and got[0]["event_ms"] == 1000
    assert varint(-1) == b"\x01" and varint(64) == b"\x80\x01"


def test_avro_cut_at_every_byte(spark):
    from telemetra.fixtures.avro_feed import encode, text, varint
    whole = encode({**RECORD, "metric": "caf\u00e9"})
    bad = [whole[:i] for i in range(len(whole))] + [
        None, b"totally_invalid", b"\xff" * 30, varint(-5) + whole, varint(2) + b"\xc3\x28" + whole[2:],
        varint(1) + b"\xc3" + varint(1) + b"\xa9" + whole[6:],        # halves of one character in two strings
        encode({**RECORD, "value": "x"}).replace(varint(1) + text("x"), varint(4) + text("x"))]
    got = avro(spark, [*bad, whole])
    assert {r["error"] for r in got[:-1]} == {"decode_failed"} and got[-1]["error"] is None
    assert all(r["thing_id"] is None and r["seq"] is None and r["num"] is None for r in got[:-1])
    assert avro(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=9), st.integers(-(1 << 62), 1 << 62), st.one_of(
    st.floats(allow_nan=False), st.text(max_size=5), st.booleans(), st.integers(-(1 << 31), (1 << 31) - 1))), max_size=12))
def test_avro_round_trip(rows):
    import pyarrow as pa

    from telemetra.fixtures.avro_feed import encode
    from telemetra.operators.avro_wire import read_batch
    payloads = [encode({**RECORD, "thing_id": t, "seq": n, "value": float(v) if isinstance(v, float) and abs(v) > 1e300 else v})
                if not (isinstance(v, float) and v in (float("inf"), float("-inf"))) else b"" for t, n, v in rows]
    got = read_batch(pa.array([b"left out", *payloads], pa.binary()).slice(1))
    for i, (t, n, v) in enumerate(rows):
        if not payloads[i]:
            assert not got["_is_obj"][i].as_py()
            continue
        assert (got["thing_id"][i].as_py(), got["seq"][i].as_py()) == (t, n)
        name = "_vbool" if isinstance(v, bool) else "_vstr" if isinstance(v, str) else "_vnum"
        assert got[name][i].as_py() == v


def test_texts_that_are_no_single_object(spark):
    texts = ['{}', '[{"thing_id":"a"}]', '"x"', '1', 'null', '1,"p":{}', '{"a":1},"p":2', '{"a":1} x', '{"a":1}} x', ' {"thing_id":null} ']
    got = reasons(spark, texts)
    assert got == ["invalid_thing_id"] + ["decode_failed"] * 8 + ["invalid_thing_id"]
