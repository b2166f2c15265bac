"""Message topics derived from pipeline outputs, as the downstream consumers see them.

The replay writes results, late records and DLQ records as JSON text; these
helpers add the delivery faults the consumers must tolerate, by fixed rules over
stable keys (so DuckDB can reproduce them): double-encoded JSON strings and
damaged payloads (FIXTURES.md F7).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.operators.decode import dlq_json, evaluation_barrier
from telemetra.operators.points import late_json, results_json

# --- fixed values: fixture fault rules ------------------------------------------------
DOUBLE_ENCODE_MOD = 3        # DLQ / late message double-encoded when arrival_seq % 3 = 0
SPOIL_DLQ_MOD = 11           # 4 no object, 5 no error
SPOIL_LATE_MOD = 5           # 1 no late_by_sec, 2 no metric, 3 no seq
SPOIL_RESULT_MOD = 13        # (window index + fire_index): 1 no count, 2 text latency, 3 no fire_index, 4 an array
HYGIENE_MOD = 9              # result payload fault by (window index + fire_index) % 9:
# 1 null, 2 empty, 3 leading NUL byte, 4 blank, 5 invalid UTF-8 byte inside, 6 not JSON


def json_string_literal(text: Column) -> Column:
    """Encode text as a JSON string literal (quotes and backslashes escaped)."""
    esc = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), esc, F.lit('"'))


def _maybe_double(df: DataFrame) -> DataFrame:
    twice = F.col("arrival_seq") % DOUBLE_ENCODE_MOD == 0
    # a barrier: the consumers read the text many times, and would inline how it was made
    return evaluation_barrier(df.withColumn("value", F.when(twice, json_string_literal(F.col("value")))
                                            .otherwise(F.col("value"))))


def _without(text: Column, *patterns: str) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, p, "")
    return text


def dlq_topic(dlq: DataFrame, spoil: bool = False) -> DataFrame:
    """DLQ messages: ``value`` text, ``timestamp_ms`` (broker time = arrival), arrival_seq.

    ``spoil``: by rule some messages are no object or lack their ``error``.
    """
    msgs = dlq_json(dlq).withColumnRenamed("arrival_ms", "timestamp_ms")
    if spoil:
        k, v = F.col("arrival_seq") % SPOIL_DLQ_MOD, F.col("value")
        msgs = msgs.withColumn("value", F.when(k == 4, F.lit("5")).when(k == 5, _without(v, '"error":"[^"]*",')).otherwise(v))
    return _maybe_double(msgs)


def late_topic(late_with_arrival: DataFrame) -> DataFrame:
    """Late-record messages with arrival columns for ordering; by rule some lack a key."""
    k, v = F.col("arrival_seq") % SPOIL_LATE_MOD, F.col("value")
    msgs = late_json(late_with_arrival).withColumn(
        "value", F.when(k == 1, _without(v, ',"late_by_sec":[^,}]*')).when(k == 2, _without(v, '"metric":"[^"]*",'))
        .when(k == 3, _without(v, '"seq":[^,}]*,')).otherwise(v))
    return _maybe_double(msgs)


def spoiled_results(results: DataFrame, window_ms: int) -> DataFrame:
    """Result messages, some of which the required-field gates must drop or complete by rule."""
    msgs = results_json(results)
    k = ((F.col("window_start") / F.lit(window_ms)).cast("bigint") + F.col("fire_index")) % SPOIL_RESULT_MOD
    v = F.col("value")
    return msgs.withColumn("value", (
        F.when(k == 1, _without(v, '"count":[0-9]+,'))
        .when(k == 2, F.regexp_replace(v, '"latency":-?[0-9]+', '"latency":"abc"'))
        .when(k == 3, _without(v, '"fire_index":[0-9]+,')).when(k == 4, F.concat(F.lit("["), v, F.lit("]"))).otherwise(v)))


def results_topic(results: DataFrame, window_ms: int) -> DataFrame:
    """Result messages as bytes, some damaged by rule (payload BINARY ``value``)."""
    msgs = results_json(results)
    k = ((F.col("window_start") / F.lit(window_ms)).cast("bigint") + F.col("fire_index")) % HYGIENE_MOD
    raw = F.encode(F.col("value"), "UTF-8")
    bad_byte = F.concat(F.encode(F.substring("value", 1, 10), "UTF-8"), F.unhex(F.lit("FF")),
                        F.encode(F.expr("substring(value, 11)"), "UTF-8"))
    payload = (F.when(k == 1, F.lit(None).cast("binary"))
               .when(k == 2, F.encode(F.lit(""), "UTF-8"))
               .when(k == 3, F.concat(F.unhex(F.lit("00")), raw))
               .when(k == 4, F.encode(F.lit("  \n "), "UTF-8"))
               .when(k == 5, bad_byte)
               .when(k == 6, F.encode(F.expr("substring(value, 1, length(value) - 1)"), "UTF-8"))
               .otherwise(raw))
    # a barrier: hygiene's filters would inline the payload many times, more code than Spark can compile
    return evaluation_barrier(msgs.select(payload.alias("value"), "result_time", "datastream_id", "window_start",
                                          "fire_index"))
