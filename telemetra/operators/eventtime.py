"""Event time, replay watermark and lateness.

Replay watermark (batch form of a bounded-out-of-orderness watermark): for the
record at arrival position i, ``wm_i = max(event_ms of records before i) - bound - 1``.
Rather than a running max over the global arrival order (one task), each window
needs only two instants:

* ``fire_at``   first arrival whose event_ms >= window_end + bound
  (from then on wm >= window_end - 1: the window has fired),
* ``expire_at`` first arrival whose event_ms >= window_end + lateness + bound + 1
  (from then on wm >= window_end + lateness: the window is closed).

Both are suffix-minimums over window indexes of per-index minimum arrivals: a
partial hash aggregate over the rows (map-side combined, one row per index) and a
two-level scan over the small index table. A row is then classified by comparing
its arrival with its window's two instants; no global ordering of rows is needed.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.constants import WindowSpec
from telemetra.session import materialize

ARRIVAL = ("arrival_ms", "arrival_seq")
BLOCK = 1024                      # window indexes per block of the suffix scan
BROADCAST_MAX_ROWS = 2_000_000    # threshold table broadcast only below this size


def arrival_key() -> Column:
    return F.struct(*[F.col(c) for c in ARRIVAL])


def window_start(ts_ms: Column, window_ms: int) -> Column:
    """Epoch-aligned tumbling window start (floors negative epochs too)."""
    return ts_ms - F.pmod(ts_ms, F.lit(window_ms))


def _floor_div(x: Column, d: int) -> Column:
    return F.floor(x / F.lit(d)).cast("bigint")


def watermark_thresholds(ok: DataFrame, spec: WindowSpec) -> DataFrame:
    """Per window index: ``fire_at`` / ``expire_at`` arrival keys (NULL = never) and
    ``n_rows`` (rows whose event falls in the window; 0 for threshold-only indexes)."""
    W = spec.window_ms
    idx = _floor_div(F.col("event_ms"), W)
    fire_idx = _floor_div(F.col("event_ms") - spec.fire_offset, W) - 1
    exp_idx = _floor_div(F.col("event_ms") - spec.expire_offset, W) - 1
    # one hash aggregate over the records (a struct minimum would sort them), a few groups a window
    few = ok.groupBy(idx.alias("idx"), fire_idx.alias("fire"), exp_idx.alias("exp")).agg(
        F.min(_packed_arrival()).alias("k"), F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast(PACKED)
    entries = few.select(F.inline(F.array(
        F.struct(F.col("idx").alias("idx"), none.alias("f"), none.alias("e"), F.col("n").alias("n")),
        F.struct(F.col("fire").alias("idx"), F.col("k").alias("f"), none.alias("e"), F.lit(0).cast("bigint").alias("n")),
        F.struct(F.col("exp").alias("idx"), none.alias("f"), F.col("k").alias("e"), F.lit(0).cast("bigint").alias("n")),
    )))
    return first_reached(entries)


def first_reached(entries: DataFrame) -> DataFrame:
    """``watermark_thresholds``' rows from (idx, f, e, n): packed arrivals from which the watermark fires or
    expires windows up to ``idx``, and rows of the window ``idx``. Suffix minima by a two-level scan."""
    per_idx = (entries.groupBy("idx").agg(F.min("f").alias("f"), F.min("e").alias("e"),
                                          F.sum("n").alias("n_rows"))
               .withColumn("blk", F.floor(F.col("idx") / BLOCK).cast("bigint")))
    # level 1: per block minimum, then minimum over all later blocks (tiny by construction:
    # one row per 1,024 windows of the time span)
    blocks = per_idx.groupBy("blk").agg(F.min("f").alias("bf"), F.min("e").alias("be"))
    later = Window.orderBy(F.col("blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("blk", F.min("bf").over(later).alias("lf"), F.min("be").over(later).alias("le"))
    # level 2: suffix minimum inside each block, partitioned by block
    inside = Window.partitionBy("blk").orderBy(F.col("idx").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    per_idx = per_idx.select("idx", "blk", "n_rows", F.min("f").over(inside).alias("sf"),
                             F.min("e").over(inside).alias("se"))
    return (per_idx.join(F.broadcast(blocks), "blk", "left")
            .select(F.col("idx").alias("widx"),
                    _unpacked(F.least("sf", "lf")).alias("fire_at"),
                    _unpacked(F.least("se", "le")).alias("expire_at"),
                    "n_rows"))


PACKED = "decimal(38,0)"
SEQ_SPAN = Decimal(10 ** 19)  # above any 64-bit arrival_seq


def _packed_arrival(ms: str = "arrival_ms", seq: Column | str = "arrival_seq") -> Column:
    """The arrival key as one number in arrival order."""
    return (F.col(ms).cast("decimal(18,0)") * F.lit(SEQ_SPAN)
            + (F.col(seq) if isinstance(seq, str) else seq)).cast(PACKED)


def _unpacked(k: Column) -> Column:
    ms = F.floor(k / F.lit(SEQ_SPAN)).cast("bigint")
    seq = (k - ms.cast("decimal(18,0)") * F.lit(SEQ_SPAN)).cast("bigint")
    return F.when(k.isNotNull(), F.struct(ms.alias("arrival_ms"), seq.alias("arrival_seq")))


def _join_small(big: DataFrame, small: DataFrame, on: str, n_small: int) -> DataFrame:
    if n_small <= BROADCAST_MAX_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, "left")


def classify_lateness(ok: DataFrame, spec: WindowSpec) -> DataFrame:
    """E2 + E4 + E5: add window bounds, ``lateness`` and the window's firing arrival.

    lateness: ``on_time`` (watermark before the row < window_end - 1),
    ``too_late`` (watermark >= window_end + lateness), else ``late_accepted``.
    """
    W = spec.window_ms
    # one row per window index, written once: counted, then joined
    thr = materialize(watermark_thresholds(ok.select("event_ms", *ARRIVAL), spec), True, "thresholds")
    n_thr = thr.count()
    rows = ok.withColumn("widx", _floor_div(F.col("event_ms"), W))
    j = _join_small(rows, thr.drop("n_rows"), "widx", n_thr)
    a = arrival_key()
    too_late = F.col("expire_at").isNotNull() & (F.col("expire_at") < a)
    on_time = F.col("fire_at").isNull() | (a <= F.col("fire_at"))
    return j.select(
        *[c for c in ok.columns],
        (F.col("widx") * W).alias("window_start"),
        (F.col("widx") * W + W).alias("window_end"),
        F.when(too_late, F.lit("too_late")).when(on_time, F.lit("on_time"))
        .otherwise(F.lit("late_accepted")).alias("lateness"),
        F.col("fire_at.arrival_ms").alias("fire_arrival_ms"),
    )


LATE_COLUMNS = ("thing_id", "datastream_id", "metric", "sensor_type", "seq", "event_time",
                "publish_time", "late_by_sec")


def late_records(classified: DataFrame, spec: WindowSpec, keep_arrival: bool = False) -> DataFrame:
    """E6 + E7: too-late rows as late side-output records.

    ``late_by_sec = round(max(0, arrival - (window_end + lateness)) / 1000, 3)``.
    """
    late = classified.filter(F.col("lateness") == "too_late")
    by = F.round(F.greatest(F.lit(0.0), (F.col("arrival_ms") - (F.col("window_end") + spec.lateness_ms))
                            / F.lit(1000.0)), 3)
    extra = list(ARRIVAL) if keep_arrival else []
    return late.select(*LATE_COLUMNS[:-1], by.alias("late_by_sec"), *extra)
