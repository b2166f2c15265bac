"""Binary form of the observation record on the wire (V1), read for a whole Arrow batch at once.

The record has no header: its fields follow one another, strings as a zigzag varint length
and UTF-8 bytes, ``seq`` as a zigzag varint, ``value`` as the index of its union member and the
member. All rows of a batch are read field by field with one cursor a row, so there is no
Python step per row. A payload that ends early, names no union member or holds a string
that is not UTF-8 is not an observation; bytes after the record are ignored, as a reader
of headerless records does.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# fixed values: the record's fields in order, and the members of the value's union
FIELDS = (("thing_id", "string"), ("datastream_id", "string"), ("metric", "string"), ("sensor_type", "string"),
          ("seq", "int"), ("event_time", "string"), ("value", "union"), ("publish_time", "string"))
DOUBLE, STRING, BOOLEAN, INT = range(4)
MAX_VARINT = 10
TEXTS = tuple(n for n, t in FIELDS if t == "string")
SCHEMA = ("_is_obj boolean, " + ", ".join(f"{n} string" for n in TEXTS) +
          ", seq bigint, value_kind string, _vnum double, _vstr string, _vbool boolean")


class Cursor:
    """Positions in the bytes of a batch, one a row; ``ok`` turns False where a row can't be read on."""

    def __init__(self, payloads: pa.Array):
        offsets = np.frombuffer(payloads.buffers()[1], dtype=np.int32)[payloads.offset:payloads.offset + len(payloads) + 1].astype(np.int64)
        data = payloads.buffers()[2]
        self.data = np.zeros(1, np.uint8) if data is None or not data.size else np.frombuffer(data, dtype=np.uint8)
        self.at, self.end = offsets[:-1].copy(), offsets[1:]
        self.ok = payloads.is_valid().to_numpy(zero_copy_only=False).copy()

    def _byte(self, at: np.ndarray) -> np.ndarray:
        return self.data[np.minimum(at, len(self.data) - 1)]

    def varint(self, where: np.ndarray) -> np.ndarray:
        """Zigzag varints of the rows ``where``; 0 elsewhere."""
        value, more = np.zeros(len(self.at), dtype=np.uint64), where & self.ok
        for k in range(MAX_VARINT):
            self.ok &= ~(more & (self.at >= self.end))
            more &= self.ok
            if not more.any():
                break
            b = self._byte(self.at).astype(np.uint64)
            value[more] |= (b[more] & np.uint64(0x7F)) << np.uint64(7 * k)
            self.at[more] += 1
            more = more & (b >= 0x80)
        self.ok &= ~more
        return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def skip(self, n: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Move on by ``n`` bytes in the rows ``where``; (rows that could, where their bytes start)."""
        self.ok &= ~where | ((n >= 0) & (n <= self.end - self.at))
        took, start = where & self.ok, self.at.copy()
        self.at[took] += n[took]
        return took, start

    def text(self, where: np.ndarray) -> pa.Array:
        """Strings of the rows ``where``; null elsewhere."""
        n = self.varint(where)
        took, start = self.skip(n, where)
        size = np.where(took, n, 0)
        ends = np.concatenate([[0], np.cumsum(size)])
        # each string's bytes in turn: a running position plus its string's distance from it
        taken = self.data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)] if ends[-1] else np.zeros(0, np.uint8)
        bad = ~_utf8(taken, ends)
        self.ok &= ~(took & bad)
        if (took & bad).any():
            keep = np.repeat(~bad, size)
            taken, size = taken[keep], np.where(bad, 0, size)
            ends = np.concatenate([[0], np.cumsum(size)])
            took = took & ~bad
        mask = pa.array(took).buffers()[1]
        return pa.StringArray.from_buffers(len(n), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(taken.tobytes()), mask)

    def double(self, where: np.ndarray) -> np.ndarray:
        took, start = self.skip(np.full(len(self.at), 8), where)
        raw = self.data[np.minimum(start[:, None] + np.arange(8), len(self.data) - 1)]
        return np.where(took, np.ascontiguousarray(raw).view("<f8")[:, 0], 0.0)

    def boolean(self, where: np.ndarray) -> np.ndarray:
        took, start = self.skip(np.ones(len(self.at), np.int64), where)
        return took & (self._byte(start) != 0)


def _utf8(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each string, whether its bytes are UTF-8."""
    good, start, size = np.ones(len(ends) - 1, dtype=bool), ends[:-1], np.diff(ends)
    if not (data >= 0x80).any():
        return good
    raw, held = data.tobytes(), size > 0
    try:
        raw.decode("utf-8")
        # together they are: each is, unless it begins inside a character
        good[held] = (data[start[held]] & 0xC0) != 0x80
        if good.all():
            return good
    except UnicodeDecodeError:
        pass
    for i in np.flatnonzero(held):
        try:
            raw[start[i]:start[i] + size[i]].decode("utf-8")
            good[i] = True
        except UnicodeDecodeError:
            good[i] = False
    return good


def read_batch(payloads: pa.Array) -> dict[str, pa.Array]:
    """Columns of ``SCHEMA``; all null where a payload is not an observation."""
    c, out = Cursor(payloads), {}
    every = np.ones(len(payloads), dtype=bool)
    for name, kind in FIELDS:
        if kind == "string":
            out[name] = c.text(every)
        elif kind == "int":
            out[name] = c.varint(every)
        else:
            member = c.varint(every)
            c.ok &= (member >= 0) & (member <= INT)
            is_ = [c.ok & (member == m) for m in range(4)]
            double, text, flag, whole = c.double(is_[DOUBLE]), c.text(is_[STRING]), c.boolean(is_[BOOLEAN]), c.varint(is_[INT])
    number = is_[DOUBLE] | is_[INT]
    shown = lambda values, where: pa.array(values, mask=~(where & c.ok))
    vnum = shown(np.where(is_[INT], whole.astype(np.float64), double), number)
    told = pc.if_else(pa.array(is_[INT]), pa.array(whole).cast(pa.string()), pa.array(double).cast(pa.string()))
    gone = pa.scalar(None, pa.string())
    ok = pa.array(c.ok)
    kind = np.where(number, "number", np.where(is_[STRING], "string", "bool"))
    return {"_is_obj": ok, **{n: pc.if_else(ok, out[n], gone) for n in TEXTS}, "seq": shown(out["seq"], every),
            "value_kind": shown(kind, every).cast(pa.string()), "_vnum": vnum,
            "_vstr": pc.if_else(ok, pc.if_else(pa.array(number), told, text), gone), "_vbool": shown(flag, is_[BOOLEAN])}


def avro_fields(raw: DataFrame, payload_col: str = "payload") -> DataFrame:
    """``raw`` with the payload's fields (``SCHEMA``) in its place, and ``size_bytes``."""
    keep = [c for c in raw.columns if c != payload_col]
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    sized = raw.select(*keep, F.octet_length(payload_col).alias("size_bytes"), F.col(payload_col).alias("_payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = read_batch(batch.column(batch.num_columns - 1).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(found[n] for n in names)],
                                             names=[*keep, "size_bytes", *names])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields[:-1])
    return sized.mapInArrow(run, f"{kept}, {SCHEMA}")
