"""Decode raw observation messages, validate them and route bad ones (V1-V9).

Decoding is one JVM-side ``try_parse_json`` into VARIANT; every type test of the
validation is a ``schema_of_variant`` comparison, so the whole step stays inside
whole-stage codegen with no Python hop. With ``wire="avro"`` the binary record is read by
``avro_wire`` (one Arrow pass) and goes through the same validation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.constants import DECODE_FAILED, SENSOR_TYPES
from telemetra.functions.text import is_blank
from telemetra.functions.timeparse import micros_to_iso, parse_iso
from telemetra.operators.avro_wire import avro_fields

STRING_FIELDS = ("thing_id", "datastream_id", "metric", "sensor_type", "event_time", "publish_time")
_NUM_KINDS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))$"
NOT_DECODED = {"json": "payload is not a JSON object", "avro": "payload is not an observation record"}
INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1       # seq is a 32-bit integer on the wire


def _value_kind(k: Column) -> Column:
    return (F.when(k.isNull() | (k == "VOID"), F.lit("null"))
            .when(k == "STRING", F.lit("string"))
            .when(k == "BOOLEAN", F.lit("bool"))
            .when(k.rlike(_NUM_KINDS), F.lit("number"))
            .otherwise(F.lit("other")))


WIRE_FIELDS = ("thing_id", "datastream_id", "metric", "sensor_type", "seq", "event_time",
               "value", "publish_time")


def _json_object(text: Column) -> Column:
    """The text as VARIANT under key ``o``, NULL unless the whole text is one JSON value.

    The parser stops after the first value, so the text is parsed inside an object: what
    follows its value breaks the object. Only a value that closes the object itself
    (``{..}}``) could hide text behind it; where the first ``}`` is not the text's last
    character, the text must also parse inside an array.
    """
    inside = F.try_parse_json(F.concat(F.lit('{"o":'), text, F.lit("}")))
    flat = F.instr(text, "}") == F.length(F.rtrim(text))
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(flat | array.isNotNull(), inside)


def wire_fields(raw: DataFrame, payload_col: str = "payload") -> DataFrame:
    """V1: payload bytes -> ``_is_obj`` and one VARIANT ``_w_<field>`` per wire field, other columns kept."""
    keep = [c for c in raw.columns if c != payload_col]
    size = F.octet_length(payload_col).alias("size_bytes")
    parsed = raw.select(*keep, size, _json_object(F.col(payload_col).cast("string")).alias("_v"))
    # one walk over the object finds all fields; a value that is no object has no struct
    fields = ", ".join(f"{f}: variant" for f in WIRE_FIELDS)
    parsed = parsed.select(*keep, "size_bytes", F.try_variant_get("_v", "$.o", f"struct<{fields}>").alias("_o"))
    return parsed.select(*keep, "size_bytes", F.col("_o").isNotNull().alias("_is_obj"),
                         *[F.col(f"_o.{f}").alias(f"_w_{f}") for f in WIRE_FIELDS])


def parse_payload(raw: DataFrame, payload_col: str = "payload", wire: str = "json") -> DataFrame:
    """V1: bytes -> typed observation columns plus per-field type kinds.

    A payload that is not one JSON object (``wire="avro"``: not one record) is
    ``decode_failed``. Keeps every other input column.
    """
    keep = [c for c in raw.columns if c != payload_col]
    if wire == "avro":
        kind = lambda name: F.when(F.col("_is_obj"), F.lit(name))
        typed = avro_fields(raw, payload_col).withColumn("value_kind", F.coalesce("value_kind", F.lit("null")))
        return typed.select("*", *[kind("STRING").alias(f"_{n}_kind") for n in STRING_FIELDS], kind("BIGINT").alias("_seq_kind"))
    if wire != "json":
        raise ValueError(f"wire format {wire!r}: json or avro")
    o = lambda f: F.col(f"_w_{f}")
    cols = [*keep, "size_bytes", "_is_obj"]
    for name in STRING_FIELDS:
        cols.append(F.try_variant_get(o(name), "$", "string").alias(name))
        cols.append(F.schema_of_variant(o(name)).alias(f"_{name}_kind"))
    cols += [
        F.try_variant_get(o("seq"), "$", "bigint").alias("seq"),
        F.schema_of_variant(o("seq")).alias("_seq_kind"),
        F.schema_of_variant(o("value")).alias("_value_type"),
        F.try_variant_get(o("value"), "$", "double").alias("_vnum"),
        F.try_variant_get(o("value"), "$", "string").alias("_vstr"),
        F.try_variant_get(o("value"), "$", "boolean").alias("_vbool"),
    ]
    # a projection of its own: the type is found once, not once for each kind that it is compared with
    return wire_fields(raw, payload_col).select(*cols).withColumn("value_kind", _value_kind(F.col("_value_type")))


def _bad_string(name: str) -> Column:
    return (F.col(f"_{name}_kind").isNull() | (F.col(f"_{name}_kind") != "STRING")
            | F.col(f"_{name}_blank"))


def validation_error() -> Column:
    """V3/V4: first failing check as a reason string, NULL when the record is valid."""
    sensor_type = F.col("sensor_type")
    kind = F.col("value_kind")
    numeric = kind == "number"
    # a blank text is no time either
    bad_time = lambda n: F.col(f"_{n}_kind").isNull() | (F.col(f"_{n}_kind") != "STRING") | F.col(f"_{n}_ts").isNull()
    return (
        F.when(~F.col("_is_obj"), F.lit(DECODE_FAILED))
        .when(_bad_string("thing_id"), F.lit("invalid_thing_id"))
        .when(_bad_string("datastream_id"), F.lit("invalid_datastream_id"))
        .when(_bad_string("metric"), F.lit("invalid_metric"))
        .when((F.col("_sensor_type_kind") != "STRING") | F.col("_sensor_type_kind").isNull()
              | ~sensor_type.isin(*SENSOR_TYPES), F.lit("invalid_sensor_type"))
        .when(~F.coalesce((F.col("_seq_kind") == "BIGINT") & F.col("seq").between(INT_MIN, INT_MAX), F.lit(False)),
              F.lit("invalid_seq"))
        .when(bad_time("event_time"), F.lit("invalid_event_time"))
        .when(kind == "null", F.lit("invalid_value"))
        .when(bad_time("publish_time"), F.lit("invalid_publish_time"))
        .when((sensor_type == "analog") & ~numeric, F.lit("invalid_analog_value"))
        .when((sensor_type == "counter") & ~numeric, F.lit("invalid_counter_value"))
        .when((sensor_type == "state") & ~((kind == "string") & F.col("_vstr").isin("ON", "OFF")),
              F.lit("invalid_state_value"))
        .when((sensor_type == "alarm") & (kind != "bool"), F.lit("invalid_alarm_value"))
    )


def decode_observations(raw: DataFrame, payload_col: str = "payload", wire: str = "json") -> DataFrame:
    """V1-V4 in one projection: typed columns, ``error`` (NULL = ok) and event times.

    Value is normalised to three readings used by the aggregates:
    ``num`` (float(v); bool -> 1.0/0.0), ``sval`` (str(v)) and ``bval`` (truthiness).
    """
    p = parse_payload(raw, payload_col, wire)
    p = p.select("*", *[is_blank(F.col(n)).alias(f"_{n}_blank")
                        for n in ("thing_id", "datastream_id", "metric")],
                 parse_iso(F.col("event_time")).alias("_event_time_ts"),
                 parse_iso(F.col("publish_time")).alias("_publish_time_ts"))
    kind = F.col("value_kind")
    num = (F.when(kind == "number", F.col("_vnum"))
           .when(kind == "bool", F.col("_vbool").cast("double")))
    sval = (F.when(kind == "bool", F.when(F.col("_vbool"), F.lit("True")).otherwise(F.lit("False")))
            .when(kind.isin("string", "number"), F.col("_vstr")))
    bval = (F.when(kind == "bool", F.col("_vbool"))
            .when(kind == "number", F.col("_vnum") != 0)
            .when(kind == "string", F.length("_vstr") > 0)
            .otherwise(F.lit(False)))
    keep = [c for c in p.columns if not c.startswith("_")]
    out = p.select(
        *keep,
        num.alias("num"), sval.alias("sval"), bval.alias("bval"),
        validation_error().alias("error"),
        F.when(~F.col("_is_obj"), F.lit(NOT_DECODED[wire])).alias("error_details"),
        F.unix_millis("_event_time_ts").alias("event_ms"),
        F.unix_millis("_publish_time_ts").alias("publish_ms"),
    )
    return evaluation_barrier(out)


def evaluation_barrier(df: DataFrame) -> DataFrame:
    """Keep later filters from being pushed into (and re-evaluating) ``df``'s projections.

    Filters such as ``error IS NULL`` would otherwise be pushed below the decode
    projections with every alias inlined, repeating the JSON parse once per field
    reference (55 copies). A one-row-per-row generator is a boundary predicate
    pushdown does not cross; it costs one struct build per row.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in cols]))))


OK_COLUMNS = ("thing_id", "datastream_id", "metric", "sensor_type", "seq", "event_time",
              "publish_time", "value_kind", "num", "sval", "bval", "event_ms", "publish_ms",
              "arrival_ms", "arrival_seq")


def ok_observations(decoded: DataFrame) -> DataFrame:
    """V5 (ok side): valid rows with the columns the window stage needs."""
    return decoded.filter(F.col("error").isNull()).select(*OK_COLUMNS)


def _iso_micros(ts: Column) -> Column:
    return micros_to_iso(F.unix_micros(ts))


def dlq_columns(ts_col: str = "arrival_ts") -> list[Column]:
    """V6/V7: the fields of a dead-letter record, from a decoded row.

    ``timestamp`` is the message's arrival time so replays are deterministic
    (the live job stamps processing time).
    """
    decode_fail = F.col("error") == DECODE_FAILED
    txt = lambda c, n: F.when(~decode_fail, F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)).alias(c)
    return [
        F.col("error"),
        F.substring("error_details", 1, 500).alias("error_details"),
        _iso_micros(F.col(ts_col)).alias("timestamp"),
        F.when(decode_fail, F.col("size_bytes")).alias("size_bytes"),
        txt("thing_id", 100), txt("datastream_id", 100), txt("metric", 100), txt("sensor_type", 50),
        F.when(~decode_fail, F.col("seq")).alias("seq"),
    ]


def dlq_records(decoded: DataFrame, ts_col: str = "arrival_ts") -> DataFrame:
    """V5 (DLQ side) + V6/V7: one wide row per rejected message."""
    return decoded.filter(F.col("error").isNotNull()).select(
        *dlq_columns(ts_col), *[c for c in ("arrival_ms", "arrival_seq") if c in decoded.columns])


def dlq_json(dlq: DataFrame) -> DataFrame:
    """V8: DLQ message text; the two record shapes keep their own field sets."""
    decode_fail = F.col("error") == DECODE_FAILED
    dec = F.to_json(F.struct("error", "error_details", "timestamp", "size_bytes"))
    val = F.to_json(F.struct("error", "timestamp", "thing_id", "datastream_id", "metric",
                             "sensor_type", "seq"), {"ignoreNullFields": "false"})
    return dlq.select(F.when(decode_fail, dec).otherwise(val).alias("value"), *[
        c for c in ("arrival_ms", "arrival_seq") if c in dlq.columns])


def dlq_reason_counts(dlq: DataFrame, reason_col: str = "error") -> DataFrame:
    """V9: rejected messages per reason (partial + final hash aggregate)."""
    return dlq.groupBy(F.col(reason_col).alias("reason")).agg(F.count(F.lit(1)).alias("dlq_count"))


def dlq_window_counts(dlq: DataFrame, window_ms: int, reason_col: str = "error", time_col: str = "arrival_ts") -> DataFrame:
    """V9 per window of arrival time. On a stream with a watermark on ``time_col`` a window's counts are
    appended once, when the watermark has passed it; the window is Spark's own state."""
    window = F.window(F.col(time_col), f"{window_ms} milliseconds")
    counts = dlq.groupBy(window.alias("w"), F.col(reason_col).alias("reason")).agg(F.count(F.lit(1)).alias("dlq_count"))
    return counts.select(F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end"),
                         "reason", "dlq_count")
