"""Watermark over several sources, silent ones left out.

Every source (a topic partition) has its own watermark: its largest event time - bound - 1.
The stage's watermark is the smallest over the sources that are heard from: one without a
record for ``idle_ms`` stops holding it back until its next record. It never goes back, and
stands still while all are silent.

Batch replay without a global order over the records: a source's watermark matters only
where it passes a window's end or end + lateness, so hash aggregates reduce the records to

* few rows per (source, window index): the first arrival that reaches it,
* one row per (source, ``idle_ms`` of arrival time): first and last arrival, from which the
  spans follow in which a source is heard (inside one such row no gap can be long enough).

This timeline is cut into blocks of arrival time. A block starts from what every source has
reached before it (prefix maxima over a table of sources x blocks) and is walked in arrival
order by ``mapInArrow``; the smallest index over the sources heard from is emitted where it
changes. Its first arrivals, per window, are the suffix minima of ``eventtime.first_reached``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from telemetra.constants import WindowSpec
from telemetra.operators.eventtime import PACKED, _floor_div, _packed_arrival, _unpacked, first_reached

BLOCK_WINDOWS = 512
NOTHING = -(2 ** 62)
HEARD, SILENT, REACHED = 1, 0, 2


def _spans(ok: DataFrame, source: str, idle_ms: int) -> DataFrame:
    """(source, ms, seq, what): where a source starts and stops being heard from."""
    bins = ok.groupBy(F.col(source).alias("source"), _floor_div(F.col("arrival_ms"), idle_ms).alias("bin")).agg(
        F.min(_packed_arrival()).alias("k"), F.max("arrival_ms").alias("last"))
    by = Window.partitionBy("source").orderBy("bin")
    bins = bins.select("source", _unpacked(F.col("k")).alias("first"), "last", F.lag("last").over(by).alias("before"),
                       F.lead(_unpacked(F.col("k"))["arrival_ms"]).over(by).alias("next"))
    starts = F.col("before").isNull() | (F.col("first.arrival_ms") - F.col("before") >= idle_ms)
    ends = F.col("next").isNull() | (F.col("next") - F.col("last") >= idle_ms)
    # a source falls silent before any record of that millisecond
    return bins.filter(starts).select("source", F.col("first.arrival_ms").alias("ms"), F.col("first.arrival_seq").alias("seq"),
                                      F.lit(HEARD).alias("what")).unionByName(
        bins.filter(ends).select("source", (F.col("last") + idle_ms).alias("ms"), F.lit(-1).cast("bigint").alias("seq"),
                                 F.lit(SILENT).alias("what")))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, ms, seq, what) -> smallest reached indexes over the sources heard from, where they change."""
    block, place, heard, levels, shown = None, {}, np.zeros(0, bool), np.zeros((0, 2), np.int64), (NOTHING, NOTHING)
    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("block", "source", "ms", "seq", "what", "fire", "exp")]
        for b, source, ms, seq, what, fire, exp in zip(*cols):
            if b != block:
                block, place, shown = b, {}, (NOTHING, NOTHING)
                heard, levels = np.zeros(0, bool), np.zeros((0, 2), np.int64)
            i = place.setdefault(source, len(place))
            if i == len(heard):
                heard, levels = np.append(heard, False), np.vstack([levels, [[NOTHING, NOTHING]]])
            if what != REACHED:
                heard[i] = what == HEARD
            if fire is not None:
                levels[i] = np.maximum(levels[i], (fire, exp))
            if ms is not None and heard.any():
                now = tuple(levels[heard].min(0).tolist())
                if now[0] > shown[0] or now[1] > shown[1]:
                    out.append((ms, seq, *now))
                    shown = max(shown[0], now[0]), max(shown[1], now[1])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 4)],
                                         names=["ms", "seq", "fire", "exp"])


def idle_thresholds(ok: DataFrame, spec: WindowSpec, idle_ms: int, source: str = "source") -> DataFrame:
    """Like ``eventtime.watermark_thresholds``, for the smallest watermark over the sources heard from.

    ``fire_at`` / ``expire_at``: the record, or the moment at which a source falls silent (``arrival_seq`` -1), from
    which on the watermark has passed the window's end, or its end + lateness.
    """
    W = spec.window_ms
    idx = _floor_div(F.col("event_ms"), W)
    few = ok.groupBy(F.col(source).alias("source"), idx.alias("idx"),
                     (_floor_div(F.col("event_ms") - spec.fire_offset, W) - 1).alias("fire"),
                     (_floor_div(F.col("event_ms") - spec.expire_offset, W) - 1).alias("exp")).agg(
        F.min(_packed_arrival()).alias("k"), F.count(F.lit(1)).alias("n"))
    at = _unpacked(F.col("k"))
    none = F.lit(None).cast("bigint")
    reached = few.select("source", at["arrival_ms"].alias("ms"), at["arrival_seq"].alias("seq"),
                         F.lit(REACHED).alias("what"), "fire", "exp")
    spans = _spans(ok, source, idle_ms).select("*", none.alias("fire"), none.alias("exp"))
    block = _floor_div(F.col("ms"), W * BLOCK_WINDOWS)
    timeline = reached.unionByName(spans).withColumn("block", block)
    # what every source has reached, and whether it is heard from, before each block that has changes
    ends = timeline.groupBy("source", "block").agg(
        F.max("fire").alias("fire"), F.max("exp").alias("exp"),
        F.max(F.when(F.col("what") != REACHED, F.struct("ms", "seq", "what"))).alias("last"))
    last_block = ends.agg(F.max("block")).first()[0]
    grid = ends.groupBy("source").agg(F.min("block").alias("b")).filter(F.lit(last_block is not None)) \
        .select("source", F.explode(F.sequence("b", F.lit(last_block).cast("bigint"))).alias("block")) \
        .join(ends, ["source", "block"], "left")
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = grid.select("block", "source", none.alias("ms"), none.alias("seq"),
                        F.coalesce(F.max("last").over(before)["what"], F.lit(SILENT)).alias("what"),
                        F.max("fire").over(before).alias("fire"), F.max("exp").over(before).alias("exp"))
    walked = timeline.select(*start.columns).unionByName(start).repartition("block") \
        .sortWithinPartitions("block", F.col("ms").asc_nulls_first(), "seq", "what") \
        .mapInArrow(_walk, "ms bigint, seq bigint, fire bigint, exp bigint")
    packed = _packed_arrival("ms", F.col("seq") + 1)          # a packed number is not negative
    unset = F.lit(None).cast(PACKED)
    rows = few.groupBy("idx").agg(F.sum("n").alias("n")).select("idx", unset.alias("f"), unset.alias("e"), "n")
    moves = walked.withColumn("k", packed).select(F.inline(F.array(
        F.struct(F.col("fire").alias("idx"), F.col("k").alias("f"), unset.alias("e"), F.lit(0).cast("bigint").alias("n")),
        F.struct(F.col("exp").alias("idx"), unset.alias("f"), F.col("k").alias("e"), F.lit(0).cast("bigint").alias("n")))))
    told = first_reached(rows.unionByName(moves.filter(F.col("idx") > NOTHING)))
    return told.select("widx", *[F.when(F.col(c).isNotNull(), F.struct(
        F.col(f"{c}.arrival_ms").alias("arrival_ms"), (F.col(f"{c}.arrival_seq") - 1).alias("arrival_seq"))).alias(c)
        for c in ("fire_at", "expire_at")], "n_rows")
