"""The observation feed in its binary wire form (FIXTURES.md F5): what a producer would send.

A message of the JSON feed that the record can't hold (a text ``seq``, a null value) or whose
JSON is damaged is damaged here in the ways binary messages are: cut short, another text, a
union member that there is none of, bytes that are no UTF-8.
"""
from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.constants import GARBAGE_PAYLOAD
from telemetra.fixtures import feed as FD
from telemetra.operators.avro_wire import BOOLEAN, DOUBLE, FIELDS, INT, STRING

#: faults whose messages can't be told in the record: they are damaged instead
DAMAGED = (FD.GARBAGE, FD.TEXT_SEQ, FD.DECIMAL_SEQ, FD.NULL_VALUE, FD.TRUNCATED, FD.TRAILING, FD.LED_BY_BLANK,
           FD.NOT_AN_OBJECT, FD.HIDDEN_TRAILING)


def varint(n: int) -> bytes:
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 0x7F:
        out.append(z & 0x7F | 0x80)
        z >>= 7
    return bytes([*out, z])


def text(s: str) -> bytes:
    raw = s.encode("utf-8")
    return varint(len(raw)) + raw


def union(value) -> bytes:
    if isinstance(value, bool):
        return varint(BOOLEAN) + bytes([value])
    if isinstance(value, str):
        return varint(STRING) + text(value)
    if isinstance(value, int) or value == int(value) and abs(value) < 1 << 31:      # whole readings go as integers
        return varint(INT) + varint(int(value))
    return varint(DOUBLE) + struct.pack("<d", value)


def encode(record: dict) -> bytes:
    put = {"string": text, "int": varint, "union": union}
    return b"".join(put[kind](record[name]) for name, kind in FIELDS)


def damaged(record: dict, fault: int) -> bytes:
    """A message that is no observation, in one of four ways."""
    whole = encode({**record, "seq": 0, "value": 0.5})
    way = fault % 4
    if way == 0:
        return GARBAGE_PAYLOAD.encode()
    if way == 1:
        return whole[:-1]
    if way == 2:
        return encode({**record, "seq": 0, "value": "x"}).replace(varint(STRING) + text("x"), varint(9) + text("x"))
    return varint(2) + b"\xff\xfe" + whole[1:]


def avro_feed(events: DataFrame) -> DataFrame:
    """``payload BINARY, arrival_ms, arrival_seq, arrival_ts``, like ``feed.observation_feed``."""
    names = [n for n, _ in FIELDS]
    rows = FD.observation_rows(events).select(
        *[F.col({"seq": "seq_json", "value": "value_json"}.get(n, n)).alias(n) for n in names], "fault", "arrival_ms",
        (F.col("event_id") * 2 + F.col("copy")).alias("arrival_seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.select([*names, "fault"]).to_pylist():
                value = json.loads(r["value"])
                if value is None or r["fault"] in DAMAGED:
                    out.append(damaged(r, r["fault"]))
                else:
                    out.append(encode({**r, "seq": int(r["seq"]), "value": value}))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("arrival_ms"), batch.column("arrival_seq")],
                                             names=["payload", "arrival_ms", "arrival_seq"])
    return rows.mapInArrow(run, "payload binary, arrival_ms bigint, arrival_seq bigint") \
        .withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))
