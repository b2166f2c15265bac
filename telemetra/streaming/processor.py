"""Structured Streaming form of the processor stage.

One checkpointed query: decode -> window state (``windows_state``: Spark's keyed state with
event-time timers) -> ``foreachBatch``. A micro-batch's results, late records and rejected
messages leave in one write, each in its own folder (``kind=pane``, ``late``, ``dlq``) and below it
in one of the batch, and last comes a commit row. The write replaces the batch's own folders,
so a retried batch changes nothing, and ``read_committed`` shows only batches that have their
commit row: what a failed batch has left is not seen (exactly once on top of the
checkpointed offsets and state).

The watermark moves once per micro-batch, which is the batch operator's behaviour when every
batch is one record.
"""
from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.constants import WindowSpec
from telemetra.operators.decode import decode_observations, dlq_columns
from telemetra.operators.eventtime import ARRIVAL, late_records
from telemetra.operators.windows import finalize, late_firing_report
from telemetra.streaming.windows_state import LATE, OUTPUT, PANE, emitted, window_events

RAW_SCHEMA = "payload binary, arrival_ms bigint, arrival_seq bigint, arrival_ts timestamp"
DLQ_SCHEMA = ("error string, error_details string, timestamp string, size_bytes int, thing_id string, datastream_id string, "
              "metric string, sensor_type string, seq bigint, arrival_ms bigint, arrival_seq bigint")


def raw_file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """S1 from files: the raw message columns, one or more files per micro-batch."""
    return (spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def raw_kafka_stream(spark: SparkSession, servers: str, topic: str,
                     starting_offsets: str = "latest") -> DataFrame:
    """S1 from a topic (needs the Kafka connector package): value bytes + broker time.

    ``arrival_seq`` orders messages within a millisecond by (partition, offset).
    """
    src = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return src.select(F.col("value").alias("payload"),
                      F.unix_millis("timestamp").alias("arrival_ms"),
                      (F.col("partition").cast("bigint") * F.lit(1 << 40) + F.col("offset")).alias("arrival_seq"),
                      F.col("timestamp").alias("arrival_ts"))


def relay(stream: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None):
    """Forward payload bytes unchanged (file sink: exactly once)."""
    w = stream.select("payload", *ARRIVAL).writeStream.format("parquet") \
        .option("path", sink_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _panes(events: DataFrame, spec: WindowSpec) -> DataFrame:
    """Wide result rows of the fired windows."""
    v = lambda c: F.struct(F.col(c).alias("v"))
    state = emitted(events, "pane", PANE).select(
        "datastream_id", "window_start", "pane", "result_ms", "n", "max_ev", "max_pub", "max_arr", "vmin", "vmax", "vsum", "tc", "fc",
        F.struct(F.col("first_type").alias("sensor_type"), F.col("first_metric").alias("metric")).alias("first_row"),
        F.col("on_n").alias("on"), F.col("off_n").alias("off"), F.array_repeat(F.lit(""), F.col("others")).alias("oset"),
        *[v(c).alias(c) for c in ("cfirst", "clast", "slast", "alast")], "batch_id")
    return finalize(state, spec.window_ms, ("batch_id",))


def _late(events: DataFrame, spec: WindowSpec) -> DataFrame:
    rows = emitted(events, "late", LATE).withColumn("window_end", F.col("window_start") + spec.window_ms)
    return late_records(rows.withColumn("lateness", F.lit("too_late")), spec)


@dataclass
class StreamProcessor:
    """foreachBatch function object; ``out_dir`` gets ``events`` and ``commits``."""

    out_dir: str

    def _write(self, df: DataFrame, name: str, batch_id: int, *by: str) -> None:
        # overwrite only this batch's partitions: a retried batch replaces its own output
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id")
         .parquet(os.path.join(self.out_dir, name)))

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        self._write(events, "events", batch_id, "kind")
        self._write(events.sparkSession.range(1).select(F.current_timestamp().alias("written")), "commits", batch_id)


def read_committed(spark: SparkSession, out_dir: str, spec: WindowSpec, name: str = "results") -> DataFrame:
    """``results``, ``late``, ``dlq`` or ``report`` (E13) of the micro-batches that are done, with their ``batch_id``."""
    done = spark.read.parquet(os.path.join(out_dir, "commits")).select("batch_id")
    events = spark.read.schema(f"{OUTPUT}, batch_id int").parquet(os.path.join(out_dir, "events")).join(done, "batch_id", "left_semi")
    if name == "dlq":
        return emitted(events.drop("datastream_id", "window_start"), "dlq", DLQ_SCHEMA)
    if name == "late":
        return _late(events, spec)
    results = _panes(events, spec)
    return results if name == "results" else late_firing_report(results)


def stream_events(raw: DataFrame, spec: WindowSpec) -> DataFrame:
    """A raw stream's panes, late records and rejected messages (``windows_state.OUTPUT``)."""
    return window_events(decode_observations(raw), F.to_json(F.struct(*dlq_columns(), *ARRIVAL)), spec)


def write_events(events: DataFrame, out_dir: str, checkpoint: str, trigger: dict | None = None):
    return (events.writeStream.foreachBatch(StreamProcessor(out_dir)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_stream(raw: DataFrame, out_dir: str, spec: WindowSpec, checkpoint: str, trigger: dict | None = None):
    """R10 + R11: one checkpointed query fanning out to results / late / DLQ."""
    return write_events(stream_events(raw, spec), out_dir, checkpoint, trigger)


def replay_stream(spark: SparkSession, feed: DataFrame, n_batches: int, folder: str, out_dir: str, spec: WindowSpec,
                  checkpoint: str, first: int = 0, stop: int | None = None) -> None:
    """Deliver a bounded feed to one checkpointed query as ``n_batches`` micro-batches, equal arrival-time spans.

    Spark's file source orders files by modification time, which files of one write don't have
    in arrival order; so every span is written into the watched folder when the one before it
    has been taken, and the query goes on from its checkpoint (R11). Timers that the last span's
    watermark makes due fire in a final batch without data.
    """
    lo, hi = feed.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    span, empty = max(1, -(-(hi - lo + 1) // n_batches)), "spark.sql.streaming.noDataMicroBatches.enabled"
    held, events = spark.conf.get(empty, "true"), None
    try:
        for k in range(first, n_batches if stop is None else stop):
            feed.filter((F.col("arrival_ms") >= lo + k * span) & (F.col("arrival_ms") < lo + (k + 1) * span)) \
                .select("payload", *ARRIVAL, "arrival_ts").write.mode("overwrite").parquet(os.path.join(folder, f"span={k:05d}"))
            spark.conf.set(empty, str(k == n_batches - 1).lower())
            if events is None:
                events = stream_events(spark.readStream.schema(RAW_SCHEMA).option("recursiveFileLookup", True).parquet(folder), spec)
            q = write_events(events, out_dir, checkpoint)
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    finally:
        spark.conf.set(empty, held)
