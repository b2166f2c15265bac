"""Streaming processor (Spark's keyed state and timers) equals the batch replay."""
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from telemetra.constants import REFERENCE_SPEC
from telemetra.operators.decode import decode_observations, dlq_records, ok_observations
from telemetra.operators.windows import windowed_results
from telemetra.streaming.processor import StreamProcessor, raw_file_stream, read_committed, replay_stream, run_stream
from conftest import feed, obs
from test_windows import F4

COLS = ["datastream_id", "window_start", "fire_index", "count", "is_late_firing", "min_value",
        "max_value", "average"]


def write_batches(rows, root):
    """One parquet file per record, with increasing modification times (arrival order)."""
    os.makedirs(root)
    for i, r in enumerate(rows):
        t = pa.table({"payload": [bytes(r["payload"])], "arrival_ms": [r["arrival_ms"]],
                      "arrival_seq": [r["arrival_seq"]],
                      "arrival_ts": pa.array([r["arrival_ts"]], pa.timestamp("us", tz="UTC"))})
        p = os.path.join(root, f"b{i:04d}.parquet")
        pq.write_table(t, p)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))


def test_stream_equals_batch_one_record_per_batch(spark):
    raw = feed(spark, F4)
    tmp = tempfile.mkdtemp(prefix="stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    write_batches(raw.orderBy("arrival_seq").collect(), os.path.join(tmp, "in"))
    q = run_stream(raw_file_stream(spark, os.path.join(tmp, "in")), os.path.join(tmp, "out"),
                   REFERENCE_SPEC, os.path.join(tmp, "ckpt"))
    q.awaitTermination(180)
    out = os.path.join(tmp, "out")
    got = read_committed(spark, out, REFERENCE_SPEC).select(*COLS)
    ok = ok_observations(decode_observations(raw))
    want, late = windowed_results(ok, REFERENCE_SPEC, flush=False)
    want = want.select(*COLS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert read_committed(spark, out, REFERENCE_SPEC, "report").count() == want.filter("is_late_firing").count() == 2
    got_late = read_committed(spark, out, REFERENCE_SPEC, "late")
    cols = ["datastream_id", "seq", "event_time", "late_by_sec", "thing_id"]
    assert sorted(map(tuple, got_late.select(*cols).collect())) == sorted(map(tuple, late.select(*cols).collect()))
    dlq = dlq_records(decode_observations(raw))
    got_dlq = read_committed(spark, out, REFERENCE_SPEC, "dlq").select(*dlq.columns)
    assert got_dlq.exceptAll(dlq).count() == 0 and dlq.exceptAll(got_dlq).count() == 0
    # Spark's state holds only open windows at the end
    open_windows = ok.select("datastream_id", (F.col("event_ms") - F.col("event_ms") % REFERENCE_SPEC.window_ms).alias("ws")) \
        .filter(F.col("ws") + REFERENCE_SPEC.window_ms + REFERENCE_SPEC.lateness_ms
                > F.lit(ok.agg(F.max("event_ms")).first()[0] - REFERENCE_SPEC.bound_ms - 1)).distinct().count()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == open_windows


def test_stream_detector_equals_batch(spark):
    from telemetra.operators import detector as DT, sequential as SQ
    from test_detector import frame, level_stream
    feat = DT.features(frame(spark, level_stream()))
    tmp = tempfile.mkdtemp(prefix="stream-det-", dir=os.environ.get("TMPDIR", "/tmp"))
    n = 600
    for b, (lo, hi) in enumerate([(0, 200), (200, 450), (450, n)]):
        part = feat.filter((F.col("window_start") >= lo * 3_600_000) & (F.col("window_start") < hi * 3_600_000))
        part.coalesce(1).write.parquet(os.path.join(tmp, "in", f"b={b}"))
        time.sleep(1.1)   # file source order = modification time
    src = (spark.readStream.schema(feat.schema).option("maxFilesPerTrigger", 1)
           .parquet(os.path.join(tmp, "in", "b=*", "*.parquet")))
    q = (SQ.detect_stream(src).writeStream.format("parquet").outputMode("append")
         .option("path", os.path.join(tmp, "out")).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    cols = ["kind", "datastream_id", "time_ms", "anomaly_score", "drift_value", "count_before_reset"]
    got = spark.read.parquet(os.path.join(tmp, "out")).select(*cols)
    want = SQ.detect(feat).select(*cols)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_detector_sorts_the_whole_batch(spark):
    """Rows in reverse order and many Arrow chunks in one micro-batch give the batch detector's events."""
    from telemetra.operators import detector as DT, sequential as SQ
    from test_detector import frame, level_stream
    feat = DT.features(frame(spark, level_stream(150)))
    tmp = tempfile.mkdtemp(prefix="stream-rev-", dir=os.environ.get("TMPDIR", "/tmp"))
    feat.orderBy(F.desc("window_start")).coalesce(1).write.parquet(os.path.join(tmp, "in"))
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    size = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "50")
        q = (SQ.detect_stream(spark.readStream.schema(feat.schema).parquet(os.path.join(tmp, "in"))).writeStream
             .format("parquet").option("path", os.path.join(tmp, "out")).option("checkpointLocation", os.path.join(tmp, "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
    finally:
        spark.conf.set(conf, size)
    cols = ["kind", "datastream_id", "time_ms", "anomaly_score", "drift_value", "count_before_reset"]
    got, want = spark.read.parquet(os.path.join(tmp, "out")).select(*cols), SQ.detect(feat).select(*cols)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_scores_equal_the_relational_ones(spark):
    """M8, M9 on a stream: sums and masses kept in Spark's state give the batch scores of every branch."""
    from telemetra.operators import detector as DT, sequential as SQ
    from test_detector import frame, mixed_streams
    feat = DT.features(frame(spark, [r for r in mixed_streams(330) if r["datastream_id"] != "x"])).cache()
    tmp = tempfile.mkdtemp(prefix="stream-hst-", dir=os.environ.get("TMPDIR", "/tmp"))
    for b, (lo, hi) in enumerate([(0, 70), (70, 211), (211, 330)]):
        feat.filter((F.col("window_start") >= lo * 3_600_000) & (F.col("window_start") < hi * 3_600_000)) \
            .coalesce(1).write.parquet(os.path.join(tmp, "in", f"b={b}"))
        time.sleep(1.1)   # file source order = modification time
    src = (spark.readStream.schema(feat.schema).option("maxFilesPerTrigger", 1)
           .parquet(os.path.join(tmp, "in", "b=*", "*.parquet")))
    q = (SQ.detect_stream(src, emit_scores=True, drift=False).writeStream.format("parquet").outputMode("append")
         .option("path", os.path.join(tmp, "out")).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    scores = lambda df: {(r["datastream_id"], r["n"]): r["anomaly_score"] for r in df.collect()}
    got = scores(spark.read.parquet(os.path.join(tmp, "out")).filter("kind = 'score'"))
    want = scores(DT.hst_scores(DT.zscores(feat)))
    assert len(want) == 4 * 330 and got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-8 for k, v in want.items())


def test_late_point_sink_on_text_stream(spark):
    import json
    from telemetra.operators.points import late_points
    from telemetra.streaming.consumers import point_sink, read_points, text_file_stream
    tmp = tempfile.mkdtemp(prefix="stream-late-", dir=os.environ.get("TMPDIR", "/tmp"))
    os.makedirs(os.path.join(tmp, "in"))
    rec = {"datastream_id": "d", "metric": "m", "seq": 3, "event_time": "2026-03-09T12:00:00+00:00",
           "late_by_sec": 1.5}
    lines = [json.dumps(rec), json.dumps(json.dumps({**rec, "late_by_sec": 2.5})),
             json.dumps({**rec, "seq": 4}), json.dumps({k: v for k, v in rec.items() if k != "event_time"})]
    ident = ["measurement", "datastream_id", "metric", "seq", "time_ms"]

    def feed_file(name, messages):
        with open(os.path.join(tmp, "in", name), "w") as fh:
            fh.write("\n".join(messages) + "\n")
        q = point_sink(text_file_stream(spark, os.path.join(tmp, "in")),
                       lambda b: late_points(b.withColumn("_o", F.monotonically_increasing_id()), keep=("_o",)),
                       ident, ["_o"], os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
        q.awaitTermination(120)
        assert q.exception() is None
        return {(r["seq"], r["late_by_seconds"]) for r in read_points(spark, os.path.join(tmp, "out"), ident).collect()}

    assert feed_file("a.txt", lines) == {("3", 2.5), ("4", 1.5)}     # same identity: the later message wins
    # a later batch replaces one point, adds one and leaves one: one row per identity in the table
    more = [json.dumps({**rec, "late_by_sec": 9.5}), json.dumps({**rec, "seq": 5})]
    assert feed_file("b.txt", more) == {("3", 9.5), ("4", 1.5), ("5", 1.5)}


def test_point_parts_over_many_batches(spark, monkeypatch):
    """50 micro-batches: the newest point of every identity, few parts left, and a merge may be run again."""
    from telemetra.streaming import consumers
    monkeypatch.setattr(consumers, "MERGE_PARTS", 4)
    path, ident, want = tempfile.mkdtemp(prefix="points-", dir=os.environ.get("TMPDIR", "/tmp")), ["id"], {}
    current = lambda: {r["id"]: r["v"] for r in consumers.read_points(spark, path, ident).collect()}
    for b in range(50):
        rows = [(i, b * 1000 + i) for i in {b % 7, (b * 5) % 11, 100 + b}]
        want.update(rows)
        spark.createDataFrame(rows, "id long, v long").withColumn("_batch", F.lit(b).cast("bigint")).coalesce(1) \
            .write.parquet(consumers._part(path, 0, b))
        if b == 31:                    # a merged part that lost its end mark, and one whose sources were not deleted yet
            delete = consumers.delete_path
            monkeypatch.setattr(consumers, "delete_path", lambda *a: None)
            consumers.merge_parts(spark, path, ident, b)
            os.remove(consumers._part(path, 1, 7) + "/_SUCCESS")
            assert current() == want
            monkeypatch.setattr(consumers, "delete_path", delete)
        consumers.merge_parts(spark, path, ident, b)
    assert current() == want
    assert len(consumers._finished(spark, path)) <= 3 * 4
    consumers.merge_parts(spark, path, ident, 47)
    assert current() == want


def test_windowed_reason_counts_on_a_stream(spark):
    """V9 with append output equals the batch counts of every window that the watermark has passed."""
    from telemetra.operators.decode import dlq_window_counts
    raw = feed(spark, ["garbage", obs(1000, seq="x"), "garbage", obs(2000), "more", obs(3000, thing=" "), obs(4000, value=None)], step_ms=4000)
    tmp = tempfile.mkdtemp(prefix="stream-dlq-", dir=os.environ.get("TMPDIR", "/tmp"))
    write_batches(raw.orderBy("arrival_seq").collect(), os.path.join(tmp, "in"))
    stream = decode_observations(raw_file_stream(spark, os.path.join(tmp, "in"))).withWatermark("arrival_ts", "1 second")
    q = (dlq_window_counts(stream.filter("error IS NOT NULL"), 10_000).writeStream.format("parquet").outputMode("append")
         .option("path", os.path.join(tmp, "out")).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    bad = dlq_records(decode_observations(raw)).withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))
    want = {tuple(r) for r in dlq_window_counts(bad, 10_000).filter("window_end <= 23000").collect()}
    assert {tuple(r) for r in spark.read.parquet(os.path.join(tmp, "out")).collect()} == want and len(want) == 3


def test_relay_forwards_bytes(spark):
    from telemetra.streaming.processor import relay
    raw = feed(spark, F4)
    tmp = tempfile.mkdtemp(prefix="stream-relay-", dir=os.environ.get("TMPDIR", "/tmp"))
    write_batches(raw.orderBy("arrival_seq").collect(), os.path.join(tmp, "in"))
    q = relay(raw_file_stream(spark, os.path.join(tmp, "in")), os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
    q.awaitTermination(180)
    got = spark.read.parquet(os.path.join(tmp, "out")).select("payload", "arrival_ms", "arrival_seq")
    want = raw.select(*got.columns)
    assert got.count() == want.count() and want.exceptAll(got).count() == 0


def test_restart_in_the_middle_equals_one_run(spark):
    raw = feed(spark, F4)
    rows = raw.orderBy("arrival_seq").collect()
    tmp = tempfile.mkdtemp(prefix="stream-restart-", dir=os.environ.get("TMPDIR", "/tmp"))
    src = os.path.join(tmp, "in")
    for stop in (5, len(rows)):              # the query ends after 5 records and starts again from its checkpoint
        for i, r in enumerate(rows[:stop]):
            p = os.path.join(src, f"b{i:04d}.parquet")
            if not os.path.exists(p):
                write_batches([r], os.path.join(tmp, f"one{i}"))
                os.makedirs(src, exist_ok=True)
                os.rename(os.path.join(tmp, f"one{i}", "b0000.parquet"), p)
                os.utime(p, (1_000_000 + i, 1_000_000 + i))
        q = run_stream(raw_file_stream(spark, src), os.path.join(tmp, "out"), REFERENCE_SPEC, os.path.join(tmp, "ckpt"))
        q.awaitTermination(180)
        assert q.exception() is None
    got = read_committed(spark, os.path.join(tmp, "out"), REFERENCE_SPEC).select(*COLS)
    want, _ = windowed_results(ok_observations(decode_observations(raw)), REFERENCE_SPEC, flush=False)
    want = want.select(*COLS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replay_stopped_and_continued_equals_one_run(spark):
    """The replay is one checkpointed query: stopped after some spans and continued, the rows are the same."""
    raw = feed(spark, F4 + [obs(5_000, seq=77), "garbage", obs(60_000, seq=78)])
    tmp = tempfile.mkdtemp(prefix="stream-replay-", dir=os.environ.get("TMPDIR", "/tmp"))
    found = []
    for name, cuts in (("one", [(0, None)]), ("two", [(0, 2), (2, None)])):
        root = os.path.join(tmp, name)
        for first, stop in cuts:
            replay_stream(spark, raw, 4, f"{root}/in", f"{root}/out", REFERENCE_SPEC, f"{root}/ckpt", first, stop)
        found.append([sorted(map(str, read_committed(spark, f"{root}/out", REFERENCE_SPEC, n).drop("batch_id").collect()))
                      for n in ("results", "late", "dlq")])
    assert found[0] == found[1] and all(found[0][:1])


def test_outputs_of_a_batch_without_commit_are_not_seen(spark, monkeypatch):
    """A batch that fails after its write shows nothing; the query goes on from its checkpoint and shows it once."""
    raw = feed(spark, F4)
    tmp = tempfile.mkdtemp(prefix="stream-commit-", dir=os.environ.get("TMPDIR", "/tmp"))
    out, args = os.path.join(tmp, "out"), (os.path.join(tmp, "in"), os.path.join(tmp, "out"), REFERENCE_SPEC, os.path.join(tmp, "ck"))
    replay_stream(spark, raw, 2, *args, 0, 1)
    before = sorted(map(str, read_committed(spark, out, REFERENCE_SPEC).collect()))
    write = StreamProcessor._write

    def fails(self, df, name, batch_id, *by):
        if name == "commits":
            raise RuntimeError("lost before the commit")
        write(self, df, name, batch_id, *by)
    monkeypatch.setattr(StreamProcessor, "_write", fails)
    with pytest.raises(Exception, match="lost before the commit"):
        replay_stream(spark, raw, 2, *args, 1)
    assert spark.read.parquet(f"{out}/events").filter("batch_id = 1").count() > 0
    assert sorted(map(str, read_committed(spark, out, REFERENCE_SPEC).collect())) == before
    monkeypatch.setattr(StreamProcessor, "_write", write)
    q = run_stream(spark.readStream.schema(raw.select("payload", "arrival_ms", "arrival_seq", "arrival_ts").schema)
                   .option("recursiveFileLookup", True).parquet(args[0]), *args[1:])
    q.awaitTermination(180)
    whole = os.path.join(tmp, "whole")
    replay_stream(spark, raw, 2, f"{whole}/in", f"{whole}/out", REFERENCE_SPEC, f"{whole}/ck")
    rows = lambda o: sorted(map(str, read_committed(spark, o, REFERENCE_SPEC).drop("batch_id").collect()))
    assert rows(out) == rows(f"{whole}/out")
