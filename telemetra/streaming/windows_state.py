"""Window state of the streaming processor (E5, E8-E12), kept by Spark per (stream, window).

``applyInPandasWithState`` groups a micro-batch by (stream, window). A group's state is a
bucket: the sequence numbers seen, the mergeable aggregates (A1-A7) and how often the window
has fired. Event-time timers fire the window once the watermark passes its end, and drop the
bucket once it passes end + lateness; nothing else of a window is kept, and only buckets
with new rows or due timers are touched in a micro-batch.

Spark drops rows older than the watermark before an event-time operator. Here such rows are
either accepted late (the window fires again) or belong to the late output, so the column
that carries the watermark into the operator is one that is never old (``undropped``); the
watermark itself comes from the event time and is read from the group's state.

A window's rows of one micro-batch meet in one task, as they must to be told apart by arrival;
their number is bounded by what the source hands to a trigger.
"""
from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from telemetra.constants import WindowSpec
from telemetra.operators.eventtime import window_start

NO_WATERMARK = -(2 ** 62)
#: groups that rejected messages pass through
DLQ_GROUPS = 64
NEVER_OLD_MS = 7_258_118_400_000       # 2200-01-01
TOLD = ("thing_id", "metric", "sensor_type", "seq", "event_time", "publish_time", "arrival_ms")
VALUES = ("event_ms", "publish_ms", "arrival_seq", "num", "sval", "bval")
#: an emitted row: its kind (pane, late, dlq), key, and its fields as JSON, read back by ``PANE`` or ``LATE``
OUTPUT = "kind string, datastream_id string, window_start long, body string"
PANE = ("pane int, result_ms long, n long, max_ev long, max_pub long, max_arr long, first_type string, first_metric string, "
        "vmin double, vmax double, vsum double, cfirst double, clast double, on_n long, off_n long, others int, slast string, "
        "tc long, fc long, alast boolean")
LATE = "thing_id string, metric string, sensor_type string, seq long, event_time string, publish_time string, arrival_ms long"
_DTYPES = {**dict.fromkeys(("seq", "event_ms", "publish_ms", "arrival_ms", "arrival_seq"), np.int64), "num": np.float64}
_NAMES = [c.split(" ")[0] for c in OUTPUT.split(", ")]
Rows = dict[str, np.ndarray]


def _item(v):
    """A plain value; None for what pandas has for null."""
    return None if v is None or v is pd.NA or v != v else v.item() if isinstance(v, np.generic) else v


class Bucket:
    """Aggregates of one window of one stream; ``None`` where no row has set them."""

    def __init__(self):
        self.fired, self.seen = 0, np.zeros(0, dtype=np.int64)
        self.n = self.on = self.off = self.tc = self.fc = 0
        self.max_ev = self.max_pub = self.max_arr = self.first = None
        self.vmin = self.vmax = self.vsum = self.cfirst = self.clast = self.slast = self.alast = None
        self.others: set[str] = set()

    @classmethod
    def load(cls, blob: bytes) -> Bucket:
        b = cls()
        vars(b).update(pickle.loads(blob))
        return b

    def dump(self) -> bytes:
        return pickle.dumps(vars(self), protocol=pickle.HIGHEST_PROTOCOL)

    def _keep(self, name: str, value, pick, key=None) -> None:
        held = getattr(self, name)
        if value is not None:
            setattr(self, name, value if held is None else pick(held, value, key=key))

    def add(self, rows: Rows) -> None:
        """Merge rows, which are in arrival order; ``seen`` is the caller's, once a call."""
        self.n += len(rows["seq"])
        for name, column in (("max_ev", "event_ms"), ("max_pub", "publish_ms"), ("max_arr", "arrival_ms")):
            self._keep(name, int(rows[column].max()), max)
        self._keep("first", tuple(_item(rows[c][0]) for c in ("arrival_ms", "arrival_seq", "sensor_type", "metric")), min)
        # (event time, arrival) order for first and last values
        order = np.lexsort((rows["arrival_seq"], rows["arrival_ms"], rows["event_ms"]))
        for name, column, i, pick in (("cfirst", "num", order[0], min), ("clast", "num", order[-1], max),
                                      ("slast", "sval", order[-1], max), ("alast", "bval", order[-1], max)):
            self._keep(name, tuple(_item(rows[c][i]) for c in ("event_ms", "arrival_ms", "arrival_seq", column)), pick,
                       key=lambda k: k[:3])
        num = rows["num"][~np.isnan(rows["num"])]
        if len(num):
            self._keep("vmin", float(num.min()), min)
            self._keep("vmax", float(num.max()), max)
            self.vsum = (self.vsum or 0.0) + float(num.sum())
        sval, bval = rows["sval"], rows["bval"]
        self.on, self.off = self.on + int((sval == "ON").sum()), self.off + int((sval == "OFF").sum())
        odd = np.isin(rows["sensor_type"], ("state", "alarm")) & (sval != "ON") & (sval != "OFF")
        self.others |= {v for v in sval[odd] if _item(v) is not None}
        self.tc, self.fc = self.tc + int((bval == True).sum()), self.fc + int((bval == False).sum())  # noqa: E712

    def pane(self, stream: str, start: int, result_ms: int) -> tuple:
        """Count a firing and tell the window as it is."""
        self.fired += 1
        body = {"pane": self.fired, "result_ms": result_ms, "n": self.n, "max_ev": self.max_ev, "max_pub": self.max_pub,
                "max_arr": self.max_arr, "first_type": self.first[2], "first_metric": self.first[3], "vmin": self.vmin,
                "vmax": self.vmax, "vsum": self.vsum, "cfirst": self.cfirst[3], "clast": self.clast[3], "on_n": self.on,
                "off_n": self.off, "others": len(self.others), "slast": self.slast[3], "tc": self.tc, "fc": self.fc,
                "alast": self.alast[3]}
        return "pane", stream, start, json.dumps(body)


def _picked(rows: Rows, which: np.ndarray) -> Rows:
    return {c: v[which] for c, v in rows.items()}


def arrival_order(bodies: list[str]) -> Rows:
    """Columns of a group's rows, in arrival order, from their JSON texts."""
    held = [json.loads(t) for t in bodies]
    rows = {c: np.array([r.get(c) for r in held], dtype=_DTYPES.get(c, object)) for c in (*TOLD, *VALUES)}
    return _picked(rows, np.lexsort((rows["arrival_seq"], rows["arrival_ms"])))


def step(bucket: Bucket | None, rows: Rows | None, stream: str, start: int, watermark: int,
         spec: WindowSpec) -> tuple[Bucket | None, list[tuple]]:
    """One call of a group: its bucket after the rows or timers of a micro-batch, and what it emits.

    ``watermark`` is that before the micro-batch; rows are in arrival order.
    """
    closes = start + spec.window_ms - 1
    out: list[tuple] = []
    if bucket is not None and not bucket.fired and watermark >= closes:
        out.append(bucket.pane(stream, start, bucket.max_arr))
    if watermark >= start + spec.window_ms + spec.lateness_ms:
        for i in range(0 if rows is None else len(rows["seq"])):
            out.append(("late", stream, start, json.dumps({c: _item(rows[c][i]) for c in TOLD})))
        return None, out
    if rows is None:
        return bucket, out
    bucket = bucket or Bucket()
    first = np.sort(np.unique(rows["seq"], return_index=True)[1])            # the first arrival of each
    fresh = first[~np.isin(rows["seq"][first], bucket.seen)]
    # once for all: a copy of the window's numbers for every late row would be quadratic
    bucket.seen = np.concatenate([bucket.seen, rows["seq"][fresh]])
    if watermark < closes:
        if len(fresh):
            bucket.add(_picked(rows, fresh))
    else:                                              # each accepted late row fires the window again
        for i in fresh:
            bucket.add(_picked(rows, np.array([i])))
            out.append(bucket.pane(stream, start, int(rows["arrival_ms"][i])))
    return bucket, out


def undropped(watermark_delay_ms: int) -> Column:
    """The column that Spark's late-row filter looks at: it carries the watermark's mark and is never old."""
    return F.timestamp_millis(F.lit(NEVER_OLD_MS)).alias("_clock", metadata={"spark.watermarkDelayMs": watermark_delay_ms})


def window_events(decoded: DataFrame, dlq: Column, spec: WindowSpec) -> DataFrame:
    """Rows of ``OUTPUT``: panes and late records of the valid rows of a decoded stream; ``dlq`` texts of the others.

    The watermark is the largest event time of earlier micro-batches - bound - 1 ms (event times
    before 1970 don't move it).
    """
    ok, delay = F.col("error").isNull(), spec.bound_ms + 1
    event_ms = F.when(ok, F.col("event_ms"))
    timed = decoded.withColumn("_event", F.timestamp_millis(F.coalesce(event_ms, F.lit(0)))).withWatermark("_event", f"{delay} milliseconds")
    salt = F.pmod(F.col("arrival_seq"), F.lit(DLQ_GROUPS))
    sent = timed.select(
        F.when(ok, F.col("datastream_id")).otherwise(F.lit("")).alias("_stream"),
        F.when(ok, window_start(event_ms, spec.window_ms)).otherwise(salt).alias("_start"),
        # one text column: Spark hands every group's columns to pandas one by one
        F.when(ok, F.to_json(F.struct(*TOLD, *VALUES))).otherwise(dlq).alias("body"), undropped(delay))

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stream, start = key
        if stream == "":                               # no valid row has a blank stream
            for pdf in pdfs:
                yield pd.DataFrame({"kind": "dlq", "datastream_id": "", "window_start": 0, "body": pdf["body"]})
            return
        rows = None if state.hasTimedOut else arrival_order([t for pdf in pdfs for t in pdf["body"]])
        watermark = state.getCurrentWatermarkMs() or NO_WATERMARK
        held = Bucket.load(state.get[0]) if state.exists else None
        bucket, out = step(held, rows, stream, int(start), watermark, spec)
        if bucket is None:
            if state.exists:
                state.remove()
        else:
            state.update((bucket.dump(),))
            # a timer is due once the watermark is beyond its time
            closes, ends = start + spec.window_ms - 1, start + spec.window_ms + spec.lateness_ms
            state.setTimeoutTimestamp(int(ends if bucket.fired else closes) - 1)
        if out:
            yield pd.DataFrame(out, columns=_NAMES)

    return sent.groupBy("_stream", "_start").applyInPandasWithState(
        run, OUTPUT, "bucket binary", "append", GroupStateTimeout.EventTimeTimeout)


def emitted(events: DataFrame, kind: str, schema: str) -> DataFrame:
    """The emitted rows of one kind: their fields, and what else of ``events``' columns."""
    keys = [c for c in events.columns if c not in ("kind", "body")]
    return events.filter(F.col("kind") == kind).select(*keys, F.from_json("body", schema).alias("b")).select(*keys, "b.*")
