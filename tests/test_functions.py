"""Scalar building blocks: typing (T1-T4), ISO time (V2, E1), keys (K1, K2), strip."""
import uuid

from pyspark.sql import functions as F

from telemetra.constants import METRIC_TYPE
from telemetra.functions import (datastream_key, identify_type, is_iso_datetime, iso_to_millis,
                                 py_strip, thing_key, type_by_metric, type_by_value)


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_type_by_metric_all_known(spark):
    rows = [(m, "null") for m in METRIC_TYPE]
    got = one(spark, type_by_metric(F.col("m"), F.col("k")), rows, "m string, k string")
    assert got == list(METRIC_TYPE.values())
    assert METRIC_TYPE["move"] == "alarm" and METRIC_TYPE["alarm"] == "state"


def test_type_by_value_and_unknown_metric(spark):
    rows = [("string",), ("bool",), ("number",), ("null",)]
    assert one(spark, type_by_value(F.col("k")), rows, "k string") == ["state", "alarm", "analog", "analog"]
    rows = [("zzz", "string"), ("zzz", "bool"), ("zzz", "number"), ("zzz", "null")]
    got = one(spark, type_by_metric(F.col("m"), F.col("k")), rows, "m string, k string")
    assert got == ["state", "alarm", "analog", "analog"]


def test_identify_type_order(spark):
    rows = [("counter", "temperature", "bool"), ("bogus", "water", "string"), (None, "zzz", "bool")]
    got = one(spark, identify_type(F.col("t"), F.col("m"), F.col("k")), rows, "t string, m string, k string")
    assert got == ["counter", "counter", "alarm"]


def test_iso_to_millis(spark):
    rows = [("1970-01-01T00:00:02.5Z",), ("1970-01-01T05:30:00+05:30",), ("1970-01-01T00:01-0030",),
            ("2000-02-29 23:59",), ("2000-03-01",)]
    got = one(spark, iso_to_millis(F.col("s")), rows, "s string")
    assert got[:3] == [2500, 0, 31 * 60_000]
    assert got[4] - got[3] == 60_000


def test_iso_predicate(spark):
    good = ["2026-03-09", "2026-03-09T12:30", "2026-03-09 12:30:00.123456", "2026-03-09T12:30:00Z",
            "2026-03-09T12:30:00+0200"]
    bad = ["2026", "2026-03", "12:30:00", "20260309", "2026-W10-1", " 2026-03-09", "2026-99-99 broken-time",
           "", None]
    got = one(spark, is_iso_datetime(F.col("s")), [(s,) for s in good + bad], "s string")
    assert got == [True] * len(good) + [False] * len(bad)


def test_uuid5_keys_match_python(spark):
    names = [("thing-1", "temperature"), ("thing-1", "humidity"), ("ä", "co2")]
    got = one(spark, datastream_key(F.col("t"), F.col("m")), names, "t string, m string")
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"{t}:{m}")) for t, m in names]
    assert got[0] != got[1]
    got = one(spark, thing_key(F.col("t"), F.col("i")), [("climate", 3)], "t string, i int")
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, "iot-simulator:climate:3"))]


def test_py_strip_unicode(spark):
    got = one(spark, py_strip(F.col("s")), [("  a b\t\n",), ("   ",)], "s string")
    assert got == ["a b", ""]


def test_iso_forms_and_blank_texts(spark):
    from telemetra.functions import is_blank
    same = ["2024-01-01T10:00:00Z", "2024-01-01 10:00", "2024-01-01T12:00+02:00", "2024-01-01T08:30:00.0-0130",
            "2024-01-01T10:00:00,000", "2024-01-01T10:00Z\n", "2024-01-01T12:00:00+0200\n"]
    got = one(spark, iso_to_millis(F.col("s")), [(s,) for s in same + ["2024-01-01", "2024-01-01\n", "2024-01-01T10:00+02:00\u0085"]], "s string")
    assert got == [1704103200000] * len(same) + [1704067200000, None, None]
    blanks = ["", " \t\n", " 　", " a ", "​", None]
    assert one(spark, is_blank(F.col("s")), [(s,) for s in blanks], "s string") == [True, True, True, False, False, None]
