"""Observation feed derived from the ``events`` table (FIXTURES.md F5).

Each event becomes one raw observation message (JSON text as bytes) with a
deterministic arrival time, so the whole pipeline can be replayed in batch or
streamed from files. Faults, repeats and delays are rules over ``event_id``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.constants import BROKEN_TIME, GARBAGE_PAYLOAD
from telemetra.functions.timeparse import millis_to_iso
from telemetra.session import compile_wide_rows

# --- fixed values: event type -> (sensor type, metric of thing 0, 1, 2, 3, 4) ------------
EVENT_SENSOR = {
    "view": ("analog", ("temperature", "co2", "voltage", "fridge", "temperature")),
    "signup": ("analog", ("humidity", "humidity", "humidity", "humidity", "humidity")),
    "purchase": ("counter", ("electricity", "water", "electricity", "water", "electricity")),
    "click": ("state", ("door", "oven", "alarm", "door", "oven")),
    "error": ("alarm", ("move", "smoke", "move", "smoke", "move")),
}
# --- fixed values: value = slope * event value + offset, so that every limit is passed ----
SCALE = {"co2": (60.0, 0.0), "voltage": (3.0, 0.0), "fridge": (-1.0, 40.0)}
# --- fixed values: fixture rules --------------------------------------------------
THINGS = 5                     # thing_id = 'thing-' || user_id % 5
REPEAT_MOD, REPEAT_REM = 50, 3  # a second copy where event_id % 50 = 3
PUBLISH_STEP_MS, PUBLISH_MOD = 200, 7
LONG_DELAY_MOD, LONG_DELAY_MS = 101, 129_600_000
SHORT_DELAY_MOD, SHORT_DELAY_MS = 97, 34_560_000
COPY_DELAY_MS = 1_000
MIXED_MOD, MIXED_REM = 193, 7  # a state stream's record sent as an alarm
NAIVE_MOD, NAIVE_REM = 23, 5   # event time without offset
FAULT_MOD = 211                # event_id % 211 picks one fault:
BLANK_METRIC, BROKEN_EVENT_TIME, BLANK_STREAM, GARBAGE, BLANK_THING, UNKNOWN_TYPE = 1, 2, 3, 4, 5, 6
TEXT_SEQ, DECIMAL_SEQ, HUGE_SEQ, NULL_VALUE, BROKEN_PUBLISH_TIME, ODD_VALUE = 7, 8, 9, 10, 11, 12
TRUNCATED, TRAILING, LED_BY_BLANK, NOT_AN_OBJECT, HIDDEN_TRAILING = 13, 14, 15, 16, 17
HUGE = 1_099_511_627_776       # beyond 32 bits
ROWS_PER_TASK = 20_000         # events that one task encodes and decodes


def _sensor_type() -> Column:
    return F.create_map(*[F.lit(x) for k, v in EVENT_SENSOR.items() for x in (k, v[0])])[F.col("event_type")]


def _metric() -> Column:
    names = F.create_map(*[x for k, v in EVENT_SENSOR.items() for x in (F.lit(k), F.array(*map(F.lit, v[1])))])
    return F.get(names[F.col("event_type")], (F.col("user_id") % THINGS).cast("int"))


def _scaled(metric: Column, value: Column) -> Column:
    out = value
    for m, (slope, offset) in SCALE.items():
        out = F.when(metric == m, F.round(value * slope + offset, 2)).otherwise(out)
    return out


def spread(df: DataFrame) -> DataFrame:
    """Deal a source's rows evenly over tasks of at most ``ROWS_PER_TASK`` rows, one a core at least.

    Encoding and decoding are CPU-bound per row, and input splits say little about rows: a file's
    rows may lie in few row groups, and then most of its splits are empty. The rows dealt are the
    raw table's, much smaller than the messages made from them.
    """
    return df.repartition(tasks_for(df.count(), df.sparkSession.sparkContext.defaultParallelism))


def tasks_for(rows: int, cores: int) -> int:
    """Tasks for so many rows: their number grows with the rows, so that a task's work does not."""
    return max(cores, -(-rows // ROWS_PER_TASK))


def observation_rows(events: DataFrame) -> DataFrame:
    """Structured observations (before encoding), one row per delivered message."""
    events = spread(events.select("event_id", "ts", "user_id", "event_type", "value", "props"))
    e = events.select(
        "event_id", "user_id", "event_type", "value", "props",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )
    e = e.withColumn("copy", F.explode(F.when(F.col("event_id") % REPEAT_MOD == REPEAT_REM,
                                              F.array(F.lit(0), F.lit(1)))
                                       .otherwise(F.array(F.lit(0)))))
    metric, declared = _metric(), _sensor_type()
    sensor_type = F.when((declared == "state") & (F.col("event_id") % MIXED_MOD == MIXED_REM), F.lit("alarm")).otherwise(declared)
    thing = F.concat(F.lit("thing-"), (F.col("user_id") % THINGS).cast("string"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    fault = F.col("event_id") % FAULT_MOD
    odd = F.when(sensor_type == "state", F.lit('"OPEN"')).otherwise(F.lit('"warm"'))
    value_json = (F.when(fault == NULL_VALUE, F.lit("null")).when(fault == ODD_VALUE, odd)
                  .when(sensor_type.isin("analog", "counter"),
                        F.coalesce(_scaled(metric, F.col("value")).cast("string"), F.lit("null")))
                  .when(sensor_type == "state",
                        F.when(k % 2 == 0, F.lit('"ON"')).otherwise(F.lit('"OFF"')))
                  .otherwise(F.when(F.col("value") > 100, F.lit("true")).otherwise(F.lit("false"))))
    publish_ms = F.col("ms") + PUBLISH_STEP_MS * (F.col("event_id") % PUBLISH_MOD)
    delay = (F.when(F.col("event_id") % LONG_DELAY_MOD == 0, F.lit(LONG_DELAY_MS))
             .when(F.col("event_id") % SHORT_DELAY_MOD == 0, F.lit(SHORT_DELAY_MS))
             .otherwise(F.lit(0)))
    blank = lambda code, c: F.when(fault == code, F.lit("   ")).otherwise(c)
    iso = millis_to_iso(F.col("ms"))
    naive = F.when(F.col("event_id") % NAIVE_MOD == NAIVE_REM, F.substring(iso, 1, 23)).otherwise(iso)
    seq = F.col("event_id").cast("string")
    return e.select(
        "event_id", "copy", fault.alias("fault"),
        blank(BLANK_THING, thing).alias("thing_id"),
        blank(BLANK_STREAM, F.concat(thing, F.lit(":"), metric)).alias("datastream_id"),
        blank(BLANK_METRIC, metric).alias("metric"),
        F.when(fault == UNKNOWN_TYPE, F.lit("gauge")).otherwise(sensor_type).alias("sensor_type"),
        F.when(fault == TEXT_SEQ, F.concat(F.lit('"'), seq, F.lit('"'))).when(fault == DECIMAL_SEQ, F.concat(seq, F.lit(".0")))
        .when(fault == HUGE_SEQ, F.lit(str(HUGE))).otherwise(seq).alias("seq_json"),
        F.when(fault == BROKEN_EVENT_TIME, F.lit(BROKEN_TIME)).otherwise(naive).alias("event_time"),
        value_json.alias("value_json"),
        F.when(fault == BROKEN_PUBLISH_TIME, F.lit(BROKEN_TIME)).otherwise(millis_to_iso(publish_ms)).alias("publish_time"),
        (publish_ms + delay + COPY_DELAY_MS * F.col("copy")).alias("arrival_ms"),
    )


def encode_json() -> Column:
    """JSON object text of one observation; ``seq`` and ``value`` keep their own JSON type."""
    text = lambda name: F.concat(F.lit(f'"{name}":"'), F.col(name), F.lit('",'))
    return F.concat(F.lit("{"), *[text(n) for n in ("thing_id", "datastream_id", "metric", "sensor_type")],
                    F.lit('"seq":'), F.col("seq_json"), F.lit(","), text("event_time"), text("publish_time"),
                    F.lit('"value":'), F.col("value_json"), F.lit("}"))


def damaged(text: Column) -> Column:
    """The payload text with the faults that break the JSON itself."""
    f = F.col("fault")
    return (F.when(f == GARBAGE, F.lit(GARBAGE_PAYLOAD)).when(f == NOT_AN_OBJECT, F.concat(F.lit("["), text, F.lit("]")))
            .when(f == TRUNCATED, F.expr("substring(t, 1, length(t) - 1)")).when(f == TRAILING, F.concat(text, F.lit(" trailing")))
            .when(f == HIDDEN_TRAILING, F.concat(text, F.lit("} x"))).when(f == LED_BY_BLANK, F.concat(F.lit("  "), text))
            .otherwise(text))


def observation_feed(events: DataFrame) -> DataFrame:
    """Raw message feed: ``payload BINARY, arrival_ms, arrival_seq, arrival_ts``.

    ``arrival_seq`` (= event_id * 2 + copy) breaks arrival-time ties, so the
    arrival order is ``(arrival_ms, arrival_seq)``.
    """
    rows = observation_rows(events).withColumn("t", encode_json())
    return rows.select(
        F.encode(damaged(F.col("t")), "UTF-8").alias("payload"),
        "arrival_ms",
        (F.col("event_id") * 2 + F.col("copy")).alias("arrival_seq"),
        F.timestamp_millis("arrival_ms").alias("arrival_ts"),
    )


def read_events(spark, sf_dir: str) -> DataFrame:
    compile_wide_rows(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")
