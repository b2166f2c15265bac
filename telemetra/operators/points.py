"""Message hygiene, JSON (de)serialisation and time-series point projections.

S2/S3/S5/S6/S7/S9, V8 and R1-R7. Consumers read JSON text from a topic or files;
everything is column expressions plus one hash aggregate for the upsert.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.constants import (DLQ_STAGE, MEASUREMENT_DLQ, MEASUREMENT_LATE,
                                 MEASUREMENT_PROCESSED)
from telemetra.functions.timeparse import parse_iso
from telemetra.operators.decode import evaluation_barrier

COMMON_RESULT = ("datastream_id", "window", "count", "sensor_type", "metric")
TAIL_RESULT = ("window_start", "window_end", "result_time", "max_event_time", "max_publish_time",
               "latency", "end_to_end_latency", "fire_index", "is_late_firing")
VARIANT_FIELDS = {
    "counter": ("first_value", "last_value", "delta"),
    "analog": ("min_value", "max_value", "average"),
    "state": ("distinct_counts", "on_count", "off_count", "last_state"),
    "alarm": ("distinct_counts", "triggered", "true_count", "false_count", "true_ratio",
              "alarm_last_value"),
}


# --------------------------------------------------------------------------- V8

def results_json(results: DataFrame) -> DataFrame:
    """V8: one JSON object per result with its sensor type's own field set.

    ``alarm_last_value`` is written as ``last_value`` like the alarm variant.
    Keeps ``result_time`` (emission order) next to the text.
    """
    st = F.col("sensor_type")

    def obj(t: str) -> Column:
        fields = [F.col(c).alias("last_value" if c == "alarm_last_value" else c)
                  for c in (*COMMON_RESULT, *VARIANT_FIELDS[t], *TAIL_RESULT)]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    text = (F.when(st == "counter", obj("counter")).when(st == "analog", obj("analog"))
            .when(st == "state", obj("state")).otherwise(obj("alarm")))
    # keep the serialiser and a downstream parser out of one generated method
    return evaluation_barrier(results.select(text.alias("value"), "result_time", "datastream_id",
                                             "window_start", "fire_index"))


LATE_FIELDS = ("thing_id", "datastream_id", "metric", "sensor_type", "seq", "event_time",
               "publish_time", "late_by_sec")


def late_json(late: DataFrame) -> DataFrame:
    """V8: late record text (nulls kept, as ``json.dumps`` does); other columns pass through."""
    text = F.to_json(F.struct(*LATE_FIELDS), {"ignoreNullFields": "false"})
    return late.select(text.alias("value"), *[c for c in late.columns if c not in LATE_FIELDS])


# --------------------------------------------------------------------------- S6/S7

_REPLACEMENT = "�"


def payload_hygiene(df: DataFrame, payload_col: str = "value") -> DataFrame:
    """Drop null/empty/NUL-led payloads, decode UTF-8 dropping bad bytes, strip,
    drop blank and non-JSON text. Adds ``text``; keeps the other columns."""
    p = F.col(payload_col)
    ok_bytes = p.isNotNull() & (F.octet_length(p) > 0) & (F.substring(p, 1, 1) != F.unhex(F.lit("00")))
    decoded = F.replace(F.make_valid_utf8(p.cast("string")), F.lit(_REPLACEMENT), F.lit(""))
    stripped = F.regexp_replace(decoded, r"(?U)^\s+|\s+$", "")
    out = df.filter(ok_bytes).withColumn("text", stripped)
    return out.filter((F.col("text") != "") & F.try_parse_json(F.col("text")).isNotNull())


def unwrap_json(text: Column) -> Column:
    """Parse JSON; when the value is itself a JSON string, parse that string."""
    v = F.try_parse_json(text)
    inner = F.try_parse_json(F.try_variant_get(v, "$", "string"))
    return F.when(F.schema_of_variant(v) == "STRING", inner).otherwise(v)


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _get(v: Column, field: str, typ: str) -> Column:
    return F.try_variant_get(v, f"$.{field}", typ)


def _absent(v: Column, field: str) -> Column:
    """The object lacks the key (a JSON null under it is not absent)."""
    return F.variant_get(v, f"$.{field}", "variant").isNull()


# --------------------------------------------------------------------------- S2/S9, R1-R4

GATE_INT = ("window_start", "window_end", "count", "latency", "end_to_end_latency", "result_time",
            "max_event_time", "max_publish_time")
GATE_STR = ("metric", "sensor_type", "datastream_id")
TYPE_POINT_FIELDS = {
    "analog": (("min_value", "double"), ("max_value", "double"), ("average", "double")),
    "counter": (("delta", "double"), ("first_value", "double"), ("last_value", "double")),
    "state": (("on_count", "bigint"), ("off_count", "bigint"), ("distinct_counts", "bigint")),
    "alarm": (("true_ratio", "double"), ("false_count", "bigint"), ("true_count", "bigint")),
}


def required_fields_gate(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """S2 + S9: parse result text, cast the required fields, drop incomplete records.

    ``fire_index`` defaults to 1 when absent. Adds ``_v`` (the parsed VARIANT) for the
    type-specific stage.
    """
    v = F.try_parse_json(F.col(text_col))
    parsed = messages.select("*", v.alias("_v")).filter(_is_object(F.col("_v")))
    vv = F.col("_v")
    fire = F.when(F.variant_get(vv, "$.fire_index", "variant").isNull(), F.lit(1).cast("bigint")) \
        .otherwise(_get(vv, "fire_index", "bigint"))
    cols = [*[_get(vv, c, "string").alias(c) for c in GATE_STR],
            *[_get(vv, c, "bigint").alias(c) for c in GATE_INT],
            fire.alias("fire_index")]
    need = [*GATE_STR, *GATE_INT, "fire_index"]
    gated = parsed.select(*[c for c in parsed.columns if c not in need], *cols)
    cond = F.lit(True)
    for c in need:
        cond = cond & F.col(c).isNotNull()
    dur = (F.col("window_end") - F.col("window_start")) / F.lit(1000.0)
    return gated.filter(cond).select(
        *[c for c in gated.columns], dur.alias("window_duration_sec"),
        F.when(dur > 0, F.col("count") / dur).otherwise(F.lit(0.0)).alias("throughput"))


POINT_COMMON = ("measurement", "sensor_type", "metric", "datastream_id", "fire_index", "time_ms",
                "window_start", "window_end", "count", "result_time", "max_event_time",
                "max_publish_time", "window_duration_sec", "latency", "end_to_end_latency",
                "throughput")


def processed_points(gated: DataFrame, sensor_type: str) -> DataFrame:
    """Points of one sensor type; rows lacking a type field are skipped.

    Tags: sensor_type, metric, datastream_id, fire_index (text); time = window_end.
    """
    fields = TYPE_POINT_FIELDS[sensor_type]
    typed = gated.filter(F.col("sensor_type") == sensor_type).select(
        "*", *[_get(F.col("_v"), n, t).alias(f"_f_{n}") for n, t in fields])
    cond = F.lit(True)
    for n, _ in fields:
        cond = cond & F.col(f"_f_{n}").isNotNull()
    return typed.filter(cond).select(
        F.lit(MEASUREMENT_PROCESSED).alias("measurement"), "sensor_type", "metric", "datastream_id",
        F.col("fire_index").cast("string").alias("fire_index"),
        F.col("window_end").alias("time_ms"),
        *POINT_COMMON[6:], *[F.col(f"_f_{n}").alias(n) for n, _ in fields])


# --------------------------------------------------------------------------- R5/R6

def dlq_points(messages: DataFrame, text_col: str = "value", ts_col: str = "timestamp_ms") -> DataFrame:
    """One point per DLQ message: reason (default 'unknown'), stage, sha256 id,
    count 1, at the broker timestamp. Messages that are not a JSON object are skipped."""
    v = unwrap_json(F.col(text_col))
    m = messages.select("*", v.alias("_v")).filter(_is_object(F.col("_v")))
    reason = F.coalesce(_get(F.col("_v"), "error", "string"), F.lit("unknown"))
    return m.select(
        F.lit(MEASUREMENT_DLQ).alias("measurement"), reason.alias("reason"),
        F.lit(DLQ_STAGE).alias("stage"), F.sha2(F.col(text_col), 256).alias("dlq_id"),
        F.lit(1).cast("bigint").alias("dlq_count"), F.col(ts_col).alias("time_ms"))


def late_points(messages: DataFrame, text_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Late-event points; records without a parseable event_time, or whose ``late_by_sec``
    is there but no number, are skipped. Only an absent key gets a default; a null ``seq`` is
    the text ``None``.

    ``keep`` columns of the message pass through (e.g. an ordering for the upsert)."""
    v = unwrap_json(F.col(text_col))
    m = messages.select("*", v.alias("_v")).filter(_is_object(F.col("_v")))
    vv = F.col("_v")
    seq_text = F.when(_absent(vv, "seq"), F.lit("NA")).otherwise(F.coalesce(_get(vv, "seq", "string"), F.lit("None")))
    late_by = F.when(_absent(vv, "late_by_sec"), F.lit(0.0)).otherwise(_get(vv, "late_by_sec", "double"))
    t = F.unix_millis(parse_iso(_get(vv, "event_time", "string")))
    return m.select(
        F.lit(MEASUREMENT_LATE).alias("measurement"),
        F.coalesce(_get(vv, "datastream_id", "string"), F.lit("unknown")).alias("datastream_id"),
        F.coalesce(_get(vv, "metric", "string"), F.lit("unknown")).alias("metric"),
        seq_text.alias("seq"),
        late_by.alias("late_by_seconds"),
        F.lit(1).cast("bigint").alias("late_count"),
        t.alias("time_ms"), *keep,
    ).filter(F.col("time_ms").isNotNull() & F.col("late_by_seconds").isNotNull())


# --------------------------------------------------------------------------- R7

def upsert_latest(points: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """Last write wins per point identity (measurement + tags + time).

    ``max(struct(order..., fields...))``: partial aggregation combines duplicates
    map-side, so a hot identity never gathers in one task.
    """
    rest = [c for c in points.columns if c not in identity and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    return (points.groupBy(*identity).agg(F.max(packed).alias("_p"))
            .select(*identity, *[F.col(f"_p.{c}").alias(c) for c in rest]))


# --------------------------------------------------------------------------- S3 (detector gate)

_DETECTOR_TYPED = {
    "analog": ("min_value", "max_value", "average"),
    "counter": ("delta", "window_start"),
    "state": ("distinct_counts",),
    "alarm": ("true_ratio", "true_count"),
}
_DETECTOR_CASTS = {"min_value": "double", "max_value": "double", "average": "double", "delta": "double",
                   "window_start": "bigint", "distinct_counts": "bigint", "true_ratio": "double",
                   "true_count": "bigint"}


def detector_gate(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """S3 + the detector's field gate: result text -> detector input rows.

    Required for every record: datastream_id, metric, sensor_type, window_end; then the
    fields of its sensor type (a record lacking one is skipped). ``result_time`` and
    ``fire_index`` (default 1) give the emission order.
    """
    v = F.try_parse_json(F.col(text_col))
    m = messages.select(v.alias("_v")).filter(_is_object(F.col("_v")))
    vv = F.col("_v")
    fire = F.when(F.variant_get(vv, "$.fire_index", "variant").isNull(), F.lit(1)) \
        .otherwise(_get(vv, "fire_index", "int"))
    cols = [_get(vv, "datastream_id", "string").alias("datastream_id"),
            _get(vv, "metric", "string").alias("metric"),
            _get(vv, "sensor_type", "string").alias("sensor_type"),
            _get(vv, "window_start", "bigint").alias("window_start"),
            _get(vv, "window_end", "bigint").alias("window_end"),
            _get(vv, "result_time", "bigint").alias("result_time"),
            fire.alias("fire_index"),
            *[_get(vv, n, t).alias(n) for n, t in _DETECTOR_CASTS.items()
              if n != "window_start"]]
    rows = m.select(*cols)
    base = (F.col("datastream_id").isNotNull() & F.col("metric").isNotNull()
            & F.col("sensor_type").isNotNull() & F.col("window_end").isNotNull())
    typed = None
    for t, fields in _DETECTOR_TYPED.items():
        ok = F.lit(True)
        for f in fields:
            ok = ok & F.col(f).isNotNull()
        cond = F.col("sensor_type") == t
        typed = F.when(cond, ok) if typed is None else typed.when(cond, ok)
    return rows.filter(base & typed.otherwise(F.lit(True)))
