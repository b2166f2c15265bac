"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given tables (the ``events`` table through the observation
feed) over their whole extent. Outputs keep deterministic columns only and round
DOUBLE columns to 6 decimals so that order-insensitive value hashes compare.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from telemetra.constants import FEATURES, FIXTURE_SPEC
from telemetra.functions.typing import identify_type, type_by_metric, type_by_value
from telemetra.operators import decode as D
from telemetra.operators.eventtime import classify_lateness, late_records, watermark_thresholds
from telemetra.operators.sources import idle_thresholds
from telemetra.operators.windows import (RESULT_COLUMNS, dedup_first_arrival, late_firing_report,
                                         plain_window_results, windowed_results)
from telemetra.operators import points as P
from telemetra.plans.oracle import TYPE_COLUMNS
from telemetra.fixtures import topics as TP
from telemetra.fixtures.avro_feed import avro_feed
from telemetra.fixtures.feed import read_events
from telemetra.operators import detector as DT
from telemetra.operators import sequential as SQ
from telemetra.plans.pipeline import fixture_feed, fixture_ok, hourly_results
from telemetra.session import materialize

SPEC = FIXTURE_SPEC
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _ok_cut(spark, sf_dir):
    """Decoded ok rows written once; window plans read them twice."""
    return materialize(fixture_ok(spark, sf_dir), True, "ok")


def _decoded(spark, sf_dir):
    return D.decode_observations(fixture_feed(spark, sf_dir))


def q_obs_typed(spark, sf_dir):
    d = _decoded(spark, sf_dir)
    return rounded(d.select("arrival_seq", "error", "thing_id", "datastream_id", "metric", "sensor_type",
                            "seq", "value_kind", "num",
                            F.when(F.col("value_kind") != "number", F.col("sval")).alias("sval"),
                            "bval", "event_ms", "publish_ms"))


def q_obs_avro(spark, sf_dir):
    """V1 on the binary wire form of the feed."""
    d = D.decode_observations(avro_feed(read_events(spark, sf_dir)), wire="avro")
    return rounded(d.select("arrival_seq", "error", "thing_id", "datastream_id", "metric", "sensor_type",
                            "seq", "value_kind", "num",
                            F.when(F.col("value_kind") != "number", F.col("sval")).alias("sval"),
                            "bval", "event_ms", "publish_ms"))


def q_ok_observations(spark, sf_dir):
    return rounded(fixture_ok(spark, sf_dir).drop("sval"))


def q_dlq_records(spark, sf_dir):
    return D.dlq_records(_decoded(spark, sf_dir))


def q_dlq_reasons(spark, sf_dir):
    return D.dlq_reason_counts(D.dlq_records(_decoded(spark, sf_dir)))


def q_dlq_reasons_windowed(spark, sf_dir):
    bad = D.dlq_records(_decoded(spark, sf_dir)).withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))
    return D.dlq_window_counts(bad, SPEC.window_ms)


def _typed(spark, sf_dir):
    return _decoded(spark, sf_dir).filter(F.col("error").isNull() | (F.col("error") != "decode_failed"))


def q_type_by_metric(spark, sf_dir):
    d = _typed(spark, sf_dir)
    return d.select("arrival_seq", "metric", "value_kind",
                    type_by_metric(F.col("metric"), F.col("value_kind")).alias("type_by_metric"))


def q_type_by_value(spark, sf_dir):
    d = _typed(spark, sf_dir)
    return d.select("arrival_seq", "value_kind",
                    type_by_value(F.col("value_kind")).alias("type_by_value"),
                    identify_type(F.col("sensor_type"), F.col("metric"), F.col("value_kind"))
                    .alias("identify_type"))


def q_lateness_classes(spark, sf_dir):
    return classify_lateness(_ok_cut(spark, sf_dir), SPEC).select(
        "arrival_ms", "arrival_seq", "datastream_id", "seq", "window_start", "window_end", "lateness")


def q_watermark_replay(spark, sf_dir):
    thr = watermark_thresholds(_ok_cut(spark, sf_dir), SPEC)
    return thr.filter(F.col("n_rows") > 0).select(
        (F.col("widx") * SPEC.window_ms).alias("window_start"),
        F.col("fire_at.arrival_ms").alias("fire_arrival_ms"),
        F.col("expire_at.arrival_ms").alias("expire_arrival_ms"),
        "n_rows")


SOURCE_IDLE_MS = 86_400_000        # the reference's 20 s, x 4,320 like the windows
SILENT_MS = 4 * SOURCE_IDLE_MS     # thing 4's source is silent for such spans: source 0 delivers its messages


def q_watermark_idle(spark, sf_dir):
    """A source per thing, one of them silent now and then."""
    thing = F.substring_index("thing_id", "-", -1).cast("int")
    silent = (thing == 4) & (F.floor(F.col("arrival_ms") / SILENT_MS) % 2 == 1)
    ok = _ok_cut(spark, sf_dir).withColumn("source", F.when(silent, 0).otherwise(thing))
    thr = idle_thresholds(ok, SPEC, SOURCE_IDLE_MS).filter(F.col("n_rows") > 0)
    return thr.select((F.col("widx") * SPEC.window_ms).alias("window_start"),
                      F.col("fire_at.arrival_ms").alias("fire_arrival_ms"), F.col("fire_at.arrival_seq").alias("fire_arrival_seq"),
                      F.col("expire_at.arrival_ms").alias("expire_arrival_ms"), F.col("expire_at.arrival_seq").alias("expire_arrival_seq"),
                      "n_rows")


def q_late_records(spark, sf_dir):
    return rounded(late_records(classify_lateness(_ok_cut(spark, sf_dir), SPEC), SPEC))


def q_dedup_seq(spark, sf_dir):
    cls = classify_lateness(_ok_cut(spark, sf_dir), SPEC)
    return dedup_first_arrival(cls.filter(F.col("lateness") != "too_late")).select(
        "datastream_id", "window_start", "seq", "arrival_ms", "arrival_seq", "lateness")


def _results(spark, sf_dir):
    return windowed_results(_ok_cut(spark, sf_dir), SPEC)[0]


def q_window_panes(spark, sf_dir):
    return rounded(_results(spark, sf_dir))


def q_late_firing_report(spark, sf_dir):
    return late_firing_report(_results(spark, sf_dir))


def q_latency_metrics(spark, sf_dir):
    r = _results(spark, sf_dir)
    dur = (F.col("window_end") - F.col("window_start")) / F.lit(1000.0)
    return rounded(r.select("datastream_id", "window_start", "fire_index", "result_time", "latency",
                            "end_to_end_latency", dur.alias("window_duration_sec"),
                            F.when(dur > 0, F.col("count") / dur).otherwise(F.lit(0.0)).alias("throughput")))


def _plain_by_type(t: str) -> Query:
    def q(spark, sf_dir):
        r = plain_window_results(fixture_ok(spark, sf_dir), SPEC.window_ms)
        return rounded(r.filter(F.col("sensor_type") == t).select(*TYPE_COLUMNS[t]))
    q.__name__ = f"q_window_{t}"
    return q


def _results_messages(spark, sf_dir):
    return TP.spoiled_results(_results(spark, sf_dir), SPEC.window_ms)


def q_required_fields_gate(spark, sf_dir):
    g = P.required_fields_gate(_results_messages(spark, sf_dir))
    return rounded(g.select(*P.GATE_STR, *P.GATE_INT, "fire_index", "window_duration_sec", "throughput"))


def _points(t: str) -> Query:
    def q(spark, sf_dir):
        return rounded(P.processed_points(P.required_fields_gate(_results_messages(spark, sf_dir)), t))
    q.__name__ = f"q_points_{t}"
    return q


def _dlq_topic(spark, sf_dir, spoil=False):
    return TP.dlq_topic(D.dlq_records(_decoded(spark, sf_dir)), spoil)


def q_dlq_points(spark, sf_dir):
    return P.dlq_points(_dlq_topic(spark, sf_dir, spoil=True))


def q_double_encoded_unwrap(spark, sf_dir):
    m = _dlq_topic(spark, sf_dir)
    v = P.unwrap_json(F.col("value"))
    return m.select("arrival_seq", F.try_variant_get(v, "$.error", "string").alias("error"),
                    F.try_variant_get(v, "$.thing_id", "string").alias("thing_id"),
                    F.try_variant_get(v, "$.seq", "bigint").alias("seq"))


def _late_topic(spark, sf_dir):
    cls = classify_lateness(_ok_cut(spark, sf_dir), SPEC)
    return TP.late_topic(late_records(cls, SPEC, keep_arrival=True))


def q_late_points(spark, sf_dir):
    return rounded(P.late_points(_late_topic(spark, sf_dir)))


LATE_POINT_ID = ["measurement", "datastream_id", "metric", "seq", "time_ms"]


def q_upsert_latest(spark, sf_dir):
    pts = P.late_points(_late_topic(spark, sf_dir).withColumn("_order", F.struct("arrival_ms", "arrival_seq")),
                        keep=("_order",))
    return rounded(P.upsert_latest(pts, LATE_POINT_ID, ["_order"]))


def q_payload_hygiene(spark, sf_dir):
    topic = TP.results_topic(_results(spark, sf_dir), SPEC.window_ms)
    clean = P.payload_hygiene(topic, "value")
    v = F.try_parse_json(F.col("text"))
    return clean.select(F.try_variant_get(v, "$.datastream_id", "string").alias("datastream_id"),
                        F.try_variant_get(v, "$.window_start", "bigint").alias("window_start"),
                        F.try_variant_get(v, "$.fire_index", "bigint").alias("fire_index"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "obs_typed": q_obs_typed,
        "obs_avro": q_obs_avro,
        "ok_observations": q_ok_observations,
        "dlq_records": q_dlq_records,
        "dlq_reasons": q_dlq_reasons,
        "dlq_reasons_windowed": q_dlq_reasons_windowed,
        "type_by_metric": q_type_by_metric,
        "type_by_value": q_type_by_value,
        "lateness_classes": q_lateness_classes,
        "watermark_replay": q_watermark_replay,
        "watermark_idle": q_watermark_idle,
        "late_records": q_late_records,
        "dedup_seq": q_dedup_seq,
        "window_panes": q_window_panes,
        "late_firing_report": q_late_firing_report,
        "latency_metrics": q_latency_metrics,
    }
    for t in ("analog", "counter", "state", "alarm"):
        q[f"window_{t}"] = _plain_by_type(t)
    q["required_fields_gate"] = q_required_fields_gate
    for t in ("analog", "counter", "state", "alarm"):
        q[f"points_{t}"] = _points(t)
    q["dlq_points"] = q_dlq_points
    q["double_encoded_unwrap"] = q_double_encoded_unwrap
    q["late_points"] = q_late_points
    q["upsert_latest"] = q_upsert_latest
    q["payload_hygiene"] = q_payload_hygiene
    q.update(detector_queries())
    q["stream_panes"] = q_stream_panes
    q["datastream_keys"] = q_datastream_keys
    q["detector_gate"] = q_detector_gate
    return q


# --------------------------------------------------------------------------- detector

def _detector_input(spark, sf_dir):
    """Hourly window results over the fixture, written once (read by several stages)."""
    return materialize(hourly_results(spark, sf_dir), True, "hourly")


def _features(spark, sf_dir):
    return DT.features(_detector_input(spark, sf_dir))


DET_KEYS = ("datastream_id", "window_start", "fire_index")


def q_calendar_features(spark, sf_dir):
    return _features(spark, sf_dir).select(*DET_KEYS, "branch", "time", "day_of_week")


def _points_of(branch: str) -> Query:
    def q(spark, sf_dir):
        f = _features(spark, sf_dir).filter(F.col("branch") == branch)
        return rounded(DT.anomaly_points(f.withColumn("anomaly_score", F.lit(None).cast("double"))))
    q.__name__ = f"q_points_of_{branch}"
    return q


def _feature_query(b: str) -> Query:
    names = FEATURES[b]

    def q(spark, sf_dir):
        f = _features(spark, sf_dir).filter(F.col("branch") == b)
        return rounded(f.select(*DET_KEYS, *[F.col(f"f{i}").alias(n) for i, n in enumerate(names)]))
    q.__name__ = f"q_features_{b}"
    return q


def _z(spark, sf_dir):
    return DT.zscores(_features(spark, sf_dir))


def q_zscores(spark, sf_dir):
    z = _z(spark, sf_dir)
    return z.select(*DET_KEYS, "n", *[F.get(F.col("zs"), i).alias(f"z{i}")
                                      for i in range(DT.MAX_FEATURES)])


def _hst(spark, sf_dir):
    return DT.hst_scores(_z(spark, sf_dir))


def q_hst_scores(spark, sf_dir):
    return rounded(_hst(spark, sf_dir).select(*DET_KEYS, "n", "anomaly_score"))


def q_anomaly_statistical(spark, sf_dir):
    return rounded(DT.anomaly_points(DT.statistical_anomalies(_hst(spark, sf_dir))))


def _events(spark, sf_dir, **kw):
    return SQ.detect(_features(spark, sf_dir), **kw)


def q_adwin_drift(spark, sf_dir):
    return rounded(SQ.drift_points(_events(spark, sf_dir)))


def q_anomaly_full(spark, sf_dir):
    ev = _events(spark, sf_dir).filter(F.col("kind") == "anomaly")
    return rounded(ev.select("measurement", "sensor_type", "metric", "datastream_id", "anomaly_type",
                             "time_ms", "anomaly_value", "average", "delta", "distinct_counts",
                             "true_count", "anomaly_score"))


def q_detector_state(spark, sf_dir):
    ev = _events(spark, sf_dir, emit_state=True).filter(F.col("kind") == "state")
    return ev.groupBy("datastream_id").agg(F.max_by("n", "version").alias("count"),
                                           F.max_by("reset_count", "version").alias("reset_count"),
                                           F.count("*").alias("snapshots"))


def detector_queries() -> dict[str, Query]:
    q: dict[str, Query] = {"calendar_features": q_calendar_features,
                           "hardware_faults": _points_of("fault"),
                           "smoke_events": _points_of("smoke")}
    for b in FEATURES:
        q[f"features_{b}"] = _feature_query(b)
    q["zscores"] = q_zscores
    q["hst_scores"] = q_hst_scores
    q["anomaly_statistical"] = q_anomaly_statistical
    q["adwin_drift"] = q_adwin_drift
    q["anomaly_full"] = q_anomaly_full
    q["detector_state"] = q_detector_state
    return q


# --------------------------------------------------------------------------- streaming

STREAM_BATCHES = 8


def q_stream_panes(spark, sf_dir):
    """The fixture feed replayed through the streaming processor: one query, 8 micro-batches."""
    from telemetra.session import scratch_path
    from telemetra.streaming.processor import read_committed, replay_stream
    root = scratch_path(spark, "stream")
    feed = materialize(fixture_feed(spark, sf_dir), True, "feed")
    replay_stream(spark, feed, STREAM_BATCHES, f"{root}/in", f"{root}/out", SPEC, f"{root}/ckpt")
    return rounded(read_committed(spark, f"{root}/out", SPEC).select(*RESULT_COLUMNS))


# --------------------------------------------------------------------------- keys (K1, K2)

def q_datastream_keys(spark, sf_dir):
    """K1/K2 over the distinct (thing, metric, type) of the ok observations."""
    from telemetra.functions.keys import datastream_key, thing_key
    ok = fixture_ok(spark, sf_dir).select("thing_id", "metric", "sensor_type").distinct()
    index = F.substring_index("thing_id", "-", -1).cast("int")
    return ok.select("thing_id", "metric", "sensor_type",
                     datastream_key(F.col("thing_id"), F.col("metric")).alias("datastream_key"),
                     thing_key(F.col("sensor_type"), index).alias("thing_key"))


def q_detector_gate(spark, sf_dir):
    """S3: hourly results as damaged messages -> hygiene -> detector gate."""
    res = _detector_input(spark, sf_dir)
    clean = P.payload_hygiene(TP.results_topic(res, SPEC.window_ms), "value")
    return rounded(P.detector_gate(clean).select(*DT.INPUT_COLUMNS))
