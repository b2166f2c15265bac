"""Per-stream online detector with ADWIN drift and model reset.

A drift resets the model, which changes every later score, so a stream is worked through in
order; between two resets everything is array work. Spark brings a stream's rows together:

    repartition(datastream_id) -> sortWithinPartitions(datastream_id, order) -> mapInArrow

and a task takes its sorted Arrow batches in chunks of at most ``CHUNK`` rows of one stream:
running standardisation by cumulative sums, tree walks and masses for the whole chunk, the
drift test at its ticks over prefix sums. A chunk in which a drift is found is kept up to the
drift's row, and the next one starts behind it with a new model. Nothing but a stream's model
(plain arrays, about 8 KB) is carried from chunk to chunk, so the same step serves batches,
micro-batches (Spark's keyed state) and a resume from snapshots.

Input rows are window results, one per stream per window and firing, so a stream's length
grows with time span / window size, not with the raw record volume.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from telemetra.constants import (ANOMALY_THRESHOLD, DRIFT_COOLDOWN, MEASUREMENT_ANOMALY, MEASUREMENT_DRIFT,
                                 MIN_SAMPLES_FOR_ANOMALY, MIN_SAMPLES_FOR_DRIFT, SNAPSHOT_EVERY)
from telemetra.operators import adwin
from telemetra.operators.detector import KEY, MAX_FEATURES, ORDER, Z_DIGITS
from telemetra.operators.hst import BRANCHES, forest, mass_scores, node_keys

EVENT_SCHEMA = (
    "kind string, measurement string, sensor_type string, metric string, datastream_id string, "
    "anomaly_type string, detector string, time_ms bigint, window_start bigint, fire_index int, "
    "result_time bigint, anomaly_value double, average double, delta double, distinct_counts bigint, "
    "true_count bigint, anomaly_score double, drift_value double, count_before_reset bigint, "
    "reset_count bigint, n bigint, version bigint, state binary")
_ARROW = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
_ARROW_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (c.split(" ") for c in EVENT_SCHEMA.split(", "))])

CHUNK = 256
SNAPSHOT_VERSION = 2
CODES = {**{b: i for i, b in enumerate(BRANCHES)}, "smoke": len(BRANCHES), "fault": len(BRANCHES) + 1}
NAMES = list(CODES)
SMOKE, FAULT = CODES["smoke"], CODES["fault"]
FEATURE_COLUMNS = [f"f{i}" for i in range(MAX_FEATURES)]
INPUT = ("branch", KEY, "sensor_type", "metric", "window_start", "window_end", "result_time", "fire_index",
         "anomaly_value", "average", "delta", "distinct_counts", "true_count", *FEATURE_COLUMNS)


# --------------------------------------------------------------------------- model of one stream

def fresh_state(reset_count: int = 0, cooldown: int = 0, seen: int = 0, version: int = 0) -> dict:
    """Plain values and arrays: nothing in a snapshot names a class of this library."""
    return {"format": SNAPSHOT_VERSION, "code": None, "count": 0, "reset_count": reset_count, "cooldown": cooldown,
            "seen": seen, "saved_at": 0, "version": version, "adwin": adwin.fresh(), "scaler": None, "trees": None}


def start_model(state: dict, code: int) -> None:
    """A new scaler and new trees; count, drift detector and cooldown stay as they are."""
    fr = forest(NAMES[code])
    w, size = fr.n_features, fr.n_trees * fr.n_nodes
    state["code"] = code
    state["scaler"] = {"n": 0, "at": np.zeros(w), "s": np.zeros(w), "q": np.zeros(w), "lo": np.full(w, np.inf), "hi": np.full(w, -np.inf)}
    # masses are at most the tree window: a byte each
    state["trees"] = {"ref": np.zeros(size, np.uint8), "latest": np.zeros(size, np.uint8), "learned": 0}


def standardise(scaler: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
    """M8 for a chunk: scores before and through each sample, and the scaler after the chunk.

    ``s`` and ``q`` are the sums of the samples' distances from ``at`` and of their squares. ``at``
    moves to the mean whenever the number of samples is a power of two, so no digits are lost
    far from zero, and the sums don't depend on how a stream is cut into chunks. z is 0
    without history or where all of it is equal.
    """
    zs, zl, i = [], [], 0
    while i < len(x):
        n = scaler["n"]
        at = scaler["at"] if n else x[i]
        j = min(len(x), i + max(1, (1 << n.bit_length()) - n))
        d = x[i:j] - at
        run = lambda first, v: np.cumsum(np.vstack([first[None, :], v]), axis=0)
        s, q = run(scaler["s"], d), run(scaler["q"], d * d)
        lo = np.minimum.accumulate(np.vstack([scaler["lo"][None, :], x[i:j]]), axis=0)
        hi = np.maximum.accumulate(np.vstack([scaler["hi"][None, :], x[i:j]]), axis=0)
        count = n + np.arange(j - i + 1)[:, None]
        mean = s / np.maximum(count, 1)
        sd = np.sqrt(np.maximum(q / np.maximum(count, 1) - mean * mean, 0.0))
        ok = (hi > lo) & (sd > 0)
        for out, k in ((zs, slice(0, -1)), (zl, slice(1, None))):
            out.append(np.round(np.where(ok[k], (d - mean[k]) / np.where(ok[k], sd[k], 1.0), 0.0), Z_DIGITS))
        n += j - i
        scaler = {"n": n, "at": at, "s": s[-1], "q": q[-1], "lo": lo[-1], "hi": hi[-1]}
        if n & (n - 1) == 0:
            scaler.update(at=at + mean[-1], s=np.zeros_like(at), q=np.maximum(q[-1] - n * mean[-1] ** 2, 0.0))
        i = j
    return np.vstack(zs), np.vstack(zl), scaler


def score_and_learn(code: int, trees: dict, zs: np.ndarray, zl: np.ndarray) -> tuple[np.ndarray, dict]:
    """M9 for a chunk: each sample against the masses of the window before its own."""
    fr = forest(NAMES[code])
    shown, taught = node_keys(NAMES[code], zs), node_keys(NAMES[code], zl)
    ref, latest, learned = trees["ref"].astype(np.int64), trees["latest"].astype(np.int64), trees["learned"]
    scores, i = np.zeros(len(zs)), 0
    while i < len(zs):
        j = min(len(zs), i + fr.window - learned % fr.window)
        if learned >= fr.window:
            scores[i:j] = mass_scores(fr, ref[shown[i:j]])
        latest += np.bincount(taught[i:j].ravel(), minlength=len(latest))
        learned += j - i
        if learned % fr.window == 0:
            ref, latest = latest, np.zeros_like(latest)
        i = j
    return scores, {"ref": ref.astype(np.uint8), "latest": latest.astype(np.uint8), "learned": learned}


def dump(state: dict) -> bytes:
    return pickle.dumps(state, protocol=pickle.HIGHEST_PROTOCOL)


def load(blob: bytes | None) -> dict:
    """M16 repair: an unreadable snapshot gives a fresh state; missing parts get defaults."""
    state = fresh_state()
    try:
        held = pickle.loads(blob)
        if not isinstance(held, dict) or held.get("format") != SNAPSHOT_VERSION:
            return state
        if held.get("code") is not None:
            start_model(state, held["code"])
        for name, value in state.items():
            if isinstance(value, dict):
                value.update({k: v for k, v in (held.get(name) or {}).items() if k in value})
            elif name in held:
                state[name] = held[name]
        return state
    except Exception:
        return fresh_state()


class Found:
    """Events of one batch: row numbers with what is not in the row, and snapshots."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.states: list[tuple] = []

    def add(self, kind: str, rows: np.ndarray, score: np.ndarray, n: np.ndarray, reset_count: int) -> None:
        if len(rows):
            self.parts.append((np.full(len(rows), kind), rows, score, n, np.full(len(rows), reset_count)))

    def snapshot(self, key: str, state: dict) -> None:
        state.update(version=state["version"] + 1, saved_at=state["seen"])
        self.states.append((key, state["count"], state["reset_count"], state["version"], dump(state)))


class Settings:
    def __init__(self, threshold: float, emit_scores: bool, emit_state: bool, drift: bool):
        self.threshold, self.emit_scores, self.emit_state, self.drift = threshold, emit_scores, emit_state, drift


def advance(state: dict, key: str, codes: np.ndarray, features: np.ndarray, first: int, end: int, to: Settings,
            found: Found) -> dict:
    """Feed rows ``first`` .. ``end`` (of one stream, in order) through its model; the state after them."""
    i = first
    while i < end:
        j = min(end, i + CHUNK, i + SNAPSHOT_EVERY - state["seen"] % SNAPSHOT_EVERY)
        part = codes[i:j]
        fed = np.flatnonzero(part < SMOKE)
        if len(fed):
            other = fed[part[fed] != part[fed[0]]]
            if len(other):                                   # another branch: its model starts a chunk of its own
                j = i + int(other[0])
                part, fed = codes[i:j], fed[fed < other[0]]
            if state["code"] != part[fed[0]]:
                start_model(state, int(part[fed[0]]))
        count = state["count"] + np.cumsum(part != FAULT)
        scores, at, after = np.zeros(0), -1, {}
        if len(fed):
            x = features[i:j][fed, :forest(NAMES[state["code"]]).n_features]
            zs, zl, after["scaler"] = standardise(state["scaler"], x)
            scores, after["trees"] = score_and_learn(state["code"], state["trees"], zs, zl)
            # the drift detector takes no scores during the cooldown, nor of the first samples
            open_ = max(state["cooldown"], int(np.searchsorted(count[fed], MIN_SAMPLES_FOR_DRIFT)))
            hit, after["adwin"] = adwin.advance(state["adwin"], scores[open_:]) if to.drift else (-1, state["adwin"])
            at = int(fed[open_ + hit]) if hit >= 0 else -1
        if at >= 0:
            j = i + at + 1
            part, count, keep = part[:at + 1], count[:at + 1], fed <= at
            fed, scores = fed[keep], scores[keep]
        reset = state["reset_count"]
        for code in (FAULT, SMOKE):
            rows = np.flatnonzero(part == code)
            found.add("anomaly", i + rows, np.ones(len(rows)), count[rows], reset)
        if at >= 0:
            found.add("drift", np.array([i + at]), scores[-1:], count[-1:], reset + 1)
            if to.emit_scores:
                found.add("score", np.array([i + at]), scores[-1:], np.zeros(1, np.int64), reset + 1)
            fed, scores = fed[:-1], scores[:-1]
        if to.emit_scores:
            found.add("score", i + fed, scores, count[fed], reset)
        odd = (scores > to.threshold) & (count[fed] >= MIN_SAMPLES_FOR_ANOMALY)
        found.add("anomaly", i + fed[odd], scores[odd], count[fed[odd]], reset)
        seen = state["seen"] + j - i
        if at >= 0:
            state = fresh_state(reset + 1, DRIFT_COOLDOWN, seen, state["version"])
        else:
            state.update(after)
            state.update(count=int(count[-1]), seen=seen, cooldown=max(0, state["cooldown"] - len(fed)))
        if to.emit_state and (at >= 0 or seen % SNAPSHOT_EVERY == 0):
            found.snapshot(key, state)
        i = j
    return state


# --------------------------------------------------------------------------- events

def _told(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in _ARROW_SCHEMA],
                                      schema=_ARROW_SCHEMA)


def event_batches(batch: pa.RecordBatch, codes: np.ndarray, found: Found) -> Iterator[pa.RecordBatch]:
    if found.parts:
        kind, rows, score, n, reset = (np.concatenate(c) for c in zip(*found.parts))
        code, taken = codes[rows], batch.take(pa.array(rows))
        drift, score_row = kind == "drift", kind == "score"
        anomaly = kind == "anomaly"
        shown = lambda v, where: pa.array(v, mask=~where)
        text = lambda value, where: pa.array(np.where(where, value, ""), mask=~where)

        def payload(name: str, *branches: str) -> pa.Array:
            where = anomaly & np.isin(code, [CODES[b] for b in branches])
            return pc.if_else(pa.array(where), taken.column(name), pa.nulls(len(rows), taken.column(name).type))
        types = np.where(code == FAULT, "hardware_fault", "statistical")
        yield _told({
            "kind": pa.array(kind), "measurement": pa.array(np.where(drift, MEASUREMENT_DRIFT, MEASUREMENT_ANOMALY), mask=score_row),
            "sensor_type": taken.column("sensor_type"), "metric": taken.column("metric"), KEY: taken.column(KEY),
            "anomaly_type": text(types, anomaly & np.isin(code, [CODES["analog"], CODES["counter"], FAULT])),
            "detector": text("ADWIN", drift), "time_ms": taken.column("window_end"), "window_start": taken.column("window_start"),
            "fire_index": taken.column("fire_index"), "result_time": taken.column("result_time"),
            "anomaly_value": payload("anomaly_value", "fault"), "average": payload("average", "analog"),
            "delta": payload("delta", "counter"), "distinct_counts": payload("distinct_counts", "state"),
            "true_count": payload("true_count", "motion", "smoke"), "anomaly_score": shown(score, ~drift),
            "drift_value": shown(score, drift), "count_before_reset": shown(n, drift),
            "reset_count": shown(reset, drift | score_row), "n": shown(n, ~drift)}, len(rows))
    if found.states:
        key, n, reset, version, blob = zip(*found.states)
        yield _told({"kind": pa.array(["state"] * len(key)), KEY: pa.array(key), "n": pa.array(n), "reset_count": pa.array(reset),
                     "version": pa.array(version), "state": pa.array(blob, pa.binary())}, len(key))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    names = batch.column("branch").to_pylist()
    codes = np.array([-1 if b is None else CODES[b] for b in names], dtype=np.int64)
    features = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in FEATURE_COLUMNS], axis=1)
    return codes, features


def _runner(to: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, fresh_state()
        for batch in batches:
            found = Found()
            codes, features = _arrays(batch)
            keys = batch.column(KEY).to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if keys[i] != key:
                    if to.emit_state and state["seen"] > state["saved_at"]:
                        found.snapshot(key, state)
                    key, state = keys[i], fresh_state()
                if codes[i] < 0:                                   # a resumed snapshot sorts before the rows
                    state, i = load(batch.column("resume_state")[i].as_py()), i + 1
                state = advance(state, key, codes, features, i, j, to, found)
            yield from event_batches(batch, codes, found)
        if to.emit_state and state["seen"] > state["saved_at"]:
            found = Found()
            found.snapshot(key, state)
            yield from event_batches(batch, codes, found)
    return run


def newest_snapshots(events: DataFrame) -> DataFrame:
    """The newest snapshot of every stream (``datastream_id, state``) among detector events."""
    return events.filter(F.col("kind") == "state").groupBy(KEY).agg(F.max_by("state", "version").alias("state"))


def detect(feat: DataFrame, threshold: float = ANOMALY_THRESHOLD, emit_scores: bool = False,
           emit_state: bool = False, partitions: int | None = None,
           resume: DataFrame | None = None, drift: bool = True) -> DataFrame:
    """Run the per-stream detector over ``detector.features`` rows.

    Output rows (``EVENT_SCHEMA``): ``kind`` = anomaly (M14) / drift (M15), plus score rows
    when ``emit_scores``, and model snapshots (``state``, M16) when ``emit_state``: every
    ``SNAPSHOT_EVERY`` rows of a stream, on a drift and at its end, numbered by ``version``.
    ``resume`` (``datastream_id, state``) goes on from snapshots. ``drift=False`` scores
    without the drift detector (M8, M9).
    """
    n = partitions or int(feat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    feat = feat.select(*INPUT)
    if resume is not None:
        # snapshots travel with the rows and sort before them
        snaps = resume.select(F.col(KEY), F.col("state").alias("resume_state"),
                              F.lit(-(2 ** 62)).cast("bigint").alias("result_time"))
        feat = feat.withColumn("resume_state", F.lit(None).cast("binary")).unionByName(snaps, allowMissingColumns=True)
    ordered = feat.repartition(n, KEY).sortWithinPartitions(KEY, *ORDER)
    return ordered.mapInArrow(_runner(Settings(threshold, emit_scores, emit_state, drift)), EVENT_SCHEMA)


def drift_points(events: DataFrame) -> DataFrame:
    """Drift points."""
    return events.filter(F.col("kind") == "drift").select(
        "measurement", "sensor_type", "metric", KEY, "detector", "time_ms", "drift_value",
        "count_before_reset", "reset_count")


def detect_stream(feat: DataFrame, threshold: float = ANOMALY_THRESHOLD, emit_scores: bool = False, drift: bool = True,
                  emit_state: bool = False) -> DataFrame:
    """M12 (and M8, M9 with ``drift=False``) on a streaming DataFrame: the model of each stream in Spark's state.

    ``applyInPandasWithState`` with no timeout: every micro-batch's rows of a stream
    are ordered and fed to its model; the model is the state (M16), so it is
    checkpointed with the query and restored after a failure.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout
    to, empty = Settings(threshold, emit_scores, emit_state, drift), _ARROW_SCHEMA.empty_table()

    def fn(key, pdfs, state):
        # chunks come in no order: the stream's rows of this micro-batch are sorted together
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values(list(ORDER))
        batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
        found, (codes, features) = Found(), _arrays(batch)
        held = advance(load(state.get[0]) if state.exists else fresh_state(), key[0], codes, features, 0, len(codes), to, found)
        state.update((dump(held),))
        told = list(event_batches(batch, codes, found))
        yield (pa.Table.from_batches(told) if told else empty).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(),
                                                                                       pa.int32(): pd.Int32Dtype()}.get)

    return feat.select(*INPUT).groupBy(KEY).applyInPandasWithState(fn, EVENT_SCHEMA, "entry binary", "append",
                                                                   GroupStateTimeout.NoTimeout)
