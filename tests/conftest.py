import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from telemetra.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


def feed(spark, records, start_ms=0, step_ms=1000):
    """Raw message feed from hand-written records (dicts -> JSON, str -> raw text), in arrival order."""
    rows = []
    for i, r in enumerate(records):
        text = r if isinstance(r, str) else json.dumps(r)
        rows.append((bytearray(text.encode("utf-8")), start_ms + i * step_ms, i))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "payload binary, arrival_ms bigint, arrival_seq bigint")
    return df.withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))


def obs(event_ms=None, seq=1, value=1.0, sensor_type="analog", metric="temperature", thing="t-0",
        ds=None, event_time=None, publish_time=None):
    from datetime import datetime, timezone
    iso = lambda ms: datetime.fromtimestamp(ms / 1000, tz=timezone.utc).isoformat()
    return {"thing_id": thing, "datastream_id": ds or f"{thing}:{metric}", "metric": metric,
            "sensor_type": sensor_type, "seq": seq,
            "event_time": event_time if event_time is not None else iso(event_ms),
            "value": value,
            "publish_time": publish_time if publish_time is not None else iso(event_ms + 100)}
