"""Downstream consumers on Structured Streaming.

Sources deliver message text (plus the broker timestamp the DLQ writer keeps);
the point projections of ``operators.points`` are row-level, so they run on the
stream as they are. The point sink is ``foreachBatch``: last write wins per point
identity over all batches (R7).
"""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.operators.points import upsert_latest
from telemetra.session import delete_path, glob_paths

TEXT_SCHEMA = "value string, timestamp_ms bigint"


def text_file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """S2-S5 from files: one message per line as ``value``; the file's modification time stands in
    for broker time, so a batch that is run again gives the same points."""
    src = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return src.select("value", F.unix_millis("_metadata.file_modification_time").alias("timestamp_ms"))


def kafka_text_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                      max_fetch_bytes: int | None = None, binary: bool = False) -> DataFrame:
    """S2-S5 from a topic (needs the Kafka connector): value text (or bytes) + broker time.

    ``max_fetch_bytes`` mirrors the late consumer's 20 MiB fetch limit.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_fetch_bytes:
        r = r.option("kafka.max.partition.fetch.bytes", str(max_fetch_bytes))
    src = r.load()
    value = F.col("value") if binary else F.col("value").cast("string")
    return src.select(value.alias("value"), F.unix_millis("timestamp").alias("timestamp_ms"))


#: parts of one level that are merged into one of the next
MERGE_PARTS = 16


def point_sink(stream: DataFrame, to_points: Callable[[DataFrame], DataFrame], identity: list[str],
               order: list[str], path: str, checkpoint: str, trigger: dict | None = None):
    """R7 + R9: keep one point per identity: the last write wins, by ``order`` within a
    micro-batch and by micro-batch beyond.

    A micro-batch appends its own newest points as one part, so it costs what its points cost.
    ``MERGE_PARTS`` parts of a level are merged into one of the next (``merge_parts``), so that a
    point is rewritten once a level and few parts are left to read; ``read_points`` takes each
    identity's newest point over them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (upsert_latest(to_points(batch), identity, order).withColumn("_batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(_part(path, 0, batch_id)))
        merge_parts(batch.sparkSession, path, identity, batch_id)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _part(path: str, level: int, number: int) -> str:
    return f"{path}/level={level}/part={number:012d}"


def _finished(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    """(level, number) of the parts whose write has ended."""
    found = re.findall(r"/level=(\d+)/part=(\d+)/_SUCCESS", "\n".join(glob_paths(spark, f"{path}/level=*/part=*/_SUCCESS")))
    return {(int(level), int(number)) for level, number in found}


def _newest(points: DataFrame, identity: list[str]) -> DataFrame:
    rest = [c for c in points.columns if c not in identity]
    return points.groupBy(*identity).agg(F.max_by(F.struct(*rest), "_batch").alias("_p")).select(*identity, "_p.*")


def merge_parts(spark: SparkSession, path: str, identity: list[str], batch_id: int) -> None:
    """Merge the levels that micro-batch ``batch_id`` completes: part i of a level replaces parts 16 i .. 16 i + 15 below.

    Safe to repeat: a part without its end mark is written anew from the parts below, which go
    only after it has it.
    """
    level = 1
    while (batch_id + 1) % MERGE_PARTS ** level == 0:
        number = batch_id // MERGE_PARTS ** level
        done = _finished(spark, path)
        below = [_part(path, level - 1, i) for i in range(number * MERGE_PARTS, (number + 1) * MERGE_PARTS) if (level - 1, i) in done]
        if (level, number) not in done and below:
            _newest(spark.read.parquet(*below), identity).write.mode("overwrite").parquet(_part(path, level, number))
        for old in below:
            delete_path(spark, old)
        level += 1


def read_points(spark: SparkSession, path: str, identity: list[str]) -> DataFrame:
    """The current points: one row per identity."""
    done = _finished(spark, path)
    covered = {(level - 1, i) for level, number in done if level
               for i in range(number * MERGE_PARTS, (number + 1) * MERGE_PARTS)}
    parts = [_part(path, level, number) for level, number in sorted(done - covered)]
    return _newest(spark.read.parquet(*parts), identity).drop("_batch")


def topic_sink(stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None,
               trigger: dict | None = None):
    """R8 + R9 to a topic (needs the Kafka connector; not run in the tests): ``value`` text, optional key."""
    cols = [F.col("value").cast("string").alias("value")] + ([F.col(key).cast("string").alias("key")] if key else [])
    return (stream.select(*cols).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
