"""Anomaly detection over window results, relational part.

Input rows are window results (``RESULT_COLUMNS``) in emission order per
``datastream_id``: ``(result_time, window_start, fire_index)``. Late re-firings
are scored like any other result.

Without drift resets every step is set-oriented:

* branch and features: column expressions (M1-M7),
* running standardisation (M8): exclusive / inclusive prefix sums per stream of the
  distance from the stream's mean and of its square, two-level (``scan.prefix_sums``)
  so a long stream is not one sort; the distances keep their digits however far the
  readings are from zero, and z is 0 only without history or where all history is equal,
* half-space-tree score (M9): sample n of a stream is in block (n-1) // window; it goes
  to its own block, to be scored, and to the next one, whose masses it makes: one
  shuffle of two rows a sample, at most 2 x window rows a group, many groups at a time
  walked with numpy over the branch's constant split tables.

The sequential form with ADWIN resets (``sequential.detect``) uses the same trees
and must agree with this one on streams where no drift fires.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.constants import (ANOMALY_THRESHOLD, FAULT_LIMITS, FEATURES,
                                 MEASUREMENT_ANOMALY, MIN_SAMPLES_FOR_ANOMALY)
from telemetra.functions.timeparse import utc_hour, utc_weekday
from telemetra.operators.hst import BRANCHES, forest, mass_scores, node_keys
from telemetra.operators.decode import evaluation_barrier
from telemetra.operators.scan import prefix_sums

KEY = "datastream_id"
ORDER = ("result_time", "window_start", "fire_index")
MAX_FEATURES = max(len(v) for v in FEATURES.values())
Z_DIGITS = 6
DAY_MS = 86_400_000

INPUT_COLUMNS = (KEY, "metric", "sensor_type", "window_start", "window_end", "result_time",
                 "fire_index", "min_value", "max_value", "average", "delta", "distinct_counts",
                 "true_ratio", "true_count")


def calendar(df: DataFrame) -> DataFrame:
    """M1: UTC hour of window_end and weekday (Monday = 0)."""
    end = F.col("window_end")
    return df.withColumn("time", utc_hour(end)).withColumn("day_of_week", utc_weekday(end))


def fault_value() -> Column:
    """M2: offending min (checked first) or max of an analog window, else NULL."""
    expr = None
    for metric, (low, high) in FAULT_LIMITS.items():
        hit = (F.when(F.col("min_value") < low, F.col("min_value"))
               .when(F.col("max_value") > high, F.col("max_value")))
        cond = F.col("metric") == metric
        expr = F.when(cond, hit) if expr is None else expr.when(cond, hit)
    return F.when(F.col("sensor_type") == "analog", expr)


def branch() -> Column:
    """Detector branch of a result: fault / analog / counter / state / motion / smoke, else NULL."""
    st, m = F.col("sensor_type"), F.col("metric")
    return (F.when((st == "analog") & fault_value().isNotNull(), F.lit("fault"))
            .when(st == "analog", F.lit("analog"))
            .when(st == "counter", F.lit("counter"))
            .when(st == "state", F.lit("state"))
            .when((st == "alarm") & (m == "smoke") & (F.col("true_count") > 0), F.lit("smoke"))
            .when((st == "alarm") & (m == "move"), F.lit("motion")))


def _feature(name: str) -> Column:
    dur = (F.col("window_end") - F.col("window_start")) / F.lit(1000.0)
    return {
        "average": F.col("average"), "min_value": F.col("min_value"),
        "max_value": F.col("max_value"),
        "spread": F.col("max_value") - F.col("min_value"),
        "delta": F.col("delta"),
        "rate": F.col("delta") / F.greatest(dur, F.lit(1.0)),
        "distinct_counts": F.col("distinct_counts").cast("double"),
        "activity_level": F.col("true_ratio"),
        "time": F.col("time").cast("double"),
        "day_of_week": F.col("day_of_week").cast("double"),
    }[name]


def features(results: DataFrame) -> DataFrame:
    """M1-M7: branch, fault value and feature columns ``f0..f5`` (NULL past the branch's width)."""
    d = calendar(results.select(*INPUT_COLUMNS))
    # the branch expression is large; a barrier keeps later filters from inlining it
    d = evaluation_barrier(d.select("*", branch().alias("branch"), fault_value().alias("anomaly_value")))
    fcols = []
    for i in range(MAX_FEATURES):
        e = None
        for b, names in FEATURES.items():
            if i < len(names):
                cond = F.col("branch") == b
                e = F.when(cond, _feature(names[i])) if e is None else e.when(cond, _feature(names[i]))
        fcols.append(e.alias(f"f{i}"))
    return d.select("*", *fcols).filter(F.col("branch").isNotNull())


def _z(x: Column, s: Column, q: Column, n: Column, lo: Column, hi: Column) -> Column:
    """Standard score of x; s and q: sums of the history's distances and of their squares."""
    mean = F.try_divide(s, n)
    sd = F.sqrt(F.greatest(F.try_divide(q, n) - mean * mean, F.lit(0.0)))
    return F.round(F.when(hi > lo, F.coalesce(F.try_divide(x - mean, sd), F.lit(0.0))).otherwise(F.lit(0.0)), Z_DIGITS)


def zscores(feat: DataFrame) -> DataFrame:
    """M8: sample number ``n`` and standardised features, before (``zs``) and through (``zl``)
    the current sample. Only model-fed rows (analog, counter, state, motion)."""
    model = feat.filter(F.col("branch").isin(*BRANCHES))
    centre = model.groupBy(KEY).agg(*[F.avg(f"f{i}").alias(f"p{i}") for i in range(MAX_FEATURES)])
    model = model.join(centre, KEY)
    measures: dict[str, Column] = {"c": F.lit(1).cast("bigint")}
    extremes: dict[str, Column] = {}
    for i in range(MAX_FEATURES):
        d = F.col(f"f{i}") - F.col(f"p{i}")
        measures[f"s{i}"] = F.coalesce(d, F.lit(0.0))
        measures[f"q{i}"] = F.coalesce(d * d, F.lit(0.0))
        extremes[f"x{i}"] = F.col(f"f{i}")
    block = F.floor(F.col("result_time") / F.lit(DAY_MS))
    pre = prefix_sums(model, [KEY], list(ORDER), block, measures, extremes=extremes)
    width = (F.when(F.col("branch") == "analog", 6).when(F.col("branch") == "counter", 4)
             .otherwise(3))
    zs, zl = [], []
    for i in range(MAX_FEATURES):
        f, s, q, c = F.col(f"f{i}"), F.col(f"s{i}"), F.col(f"q{i}"), F.col("c")
        d, lo, hi = f - F.col(f"p{i}"), F.col(f"x{i}_lo"), F.col(f"x{i}_hi")
        zs.append(_z(d, s, q, c, lo, hi))
        zl.append(_z(d, s + d, q + d * d, c + 1, F.least(lo, f), F.greatest(hi, f)))
    fnames = {f"f{i}" for i in range(MAX_FEATURES)}
    keep = [c for c in feat.columns if c not in fnames]
    return pre.select(*keep, (F.col("c") + 1).alias("n"),
                      F.slice(F.array(*zs), 1, width).alias("zs"),
                      F.slice(F.array(*zl), 1, width).alias("zl"))


#: (stream, block) groups whose masses are held at once
GROUPS_AT_ONCE = 64


def _group_starts(rows: pa.Table) -> list[int]:
    """First row of each (stream, block) of sorted rows."""
    if not rows.num_rows:
        return []
    change = np.zeros(rows.num_rows, dtype=bool)
    change[0] = True
    for name in (KEY, "blk"):
        c = rows.column(name)
        change[1:] |= pc.not_equal(c.slice(1), c.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(change).tolist()


def _scored(rows: pa.Table, starts: list[int]) -> list[pa.RecordBatch]:
    """Scores of whole (stream, block) groups: samples against the masses that the block before made."""
    fr = forest(BRANCHES[0])
    size, width = fr.n_trees * fr.n_nodes, MAX_FEATURES
    group = np.searchsorted(starts, np.arange(rows.num_rows), side="right") - 1
    lists = rows.column("z").combine_chunks()
    z = np.zeros((rows.num_rows, width))
    z[np.arange(width)[None, :] < pc.list_value_length(lists).to_numpy()[:, None]] = lists.flatten().to_numpy()
    branch = np.array(rows.column("branch").to_pylist(), dtype=object)
    keys = np.empty((rows.num_rows, fr.n_trees, fr.height + 1), dtype=np.int64)
    for b in set(branch):
        keys[branch == b] = node_keys(b, z[branch == b])
    learn = rows.column("learn").to_numpy()
    learned = np.bincount((group[learn, None, None] * size + keys[learn]).ravel(), minlength=len(starts) * size)
    known = np.bincount(group[learn], minlength=len(starts)) > 0
    at = np.flatnonzero(~learn)
    score = np.where(known[group[at]], mass_scores(fr, learned[group[at, None, None] * size + keys[at]]), 0.0)
    told = rows.select([KEY, "n"]).take(pa.array(at)).append_column("score", pa.array(score))
    return told.combine_chunks().to_batches()


def _block_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (stream, block) -> scores; the group that a batch ends in waits for the next batch."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        starts = _group_starts(rows)
        for i in range(0, len(starts) - 1, GROUPS_AT_ONCE):
            part = starts[i:min(i + GROUPS_AT_ONCE, len(starts) - 1) + 1]
            yield from _scored(rows.slice(part[0], part[-1] - part[0]), [s - part[0] for s in part[:-1]])
        held = rows.slice(starts[-1]) if starts else None
    if held is not None and held.num_rows:
        yield from _scored(held, [0])


def hst_scores(z: DataFrame) -> DataFrame:
    """M9: half-space-tree score of every model-fed sample (no drift resets)."""
    blk = F.floor((F.col("n") - 1) / F.lit(forest(BRANCHES[0]).window)).cast("bigint")
    role = lambda b, learn, v: F.struct(b.alias("blk"), F.lit(learn).alias("learn"), F.col(v).alias("z"))
    sent = z.select(KEY, "n", "branch", F.inline(F.array(role(blk, False, "zs"), role(blk + 1, True, "zl"))))
    scores = sent.repartition(KEY, "blk").sortWithinPartitions(KEY, "blk") \
        .mapInArrow(_block_scores, f"{KEY} string, n bigint, score double")
    return z.join(scores, [KEY, "n"]).select(*z.columns, blk.alias("blk"), F.round("score", 9).alias("anomaly_score"))


def statistical_anomalies(scored: DataFrame, threshold: float = ANOMALY_THRESHOLD,
                          min_samples: int = MIN_SAMPLES_FOR_ANOMALY) -> DataFrame:
    """Score above the threshold once the stream has ``min_samples`` samples."""
    return scored.filter((F.col("anomaly_score") > threshold) & (F.col("n") >= min_samples))


def anomaly_points(rows: DataFrame) -> DataFrame:
    """Anomaly points of fault, smoke and statistical rows (one wide shape).

    ``anomaly_type`` is set for analog and counter only; the payload field depends
    on the branch. Smoke rows score 1.0; fault rows carry the offending value.
    """
    b = F.col("branch")
    atype = (F.when(b == "fault", F.lit("hardware_fault"))
             .when(b.isin("analog", "counter"), F.lit("statistical")))
    score = F.when(b.isin("fault", "smoke"), F.lit(1.0)).otherwise(F.col("anomaly_score"))
    return rows.select(
        F.lit(MEASUREMENT_ANOMALY).alias("measurement"), "sensor_type", "metric", KEY,
        atype.alias("anomaly_type"), F.col("window_end").alias("time_ms"),
        F.when(b == "fault", F.col("anomaly_value")).alias("anomaly_value"),
        F.when(b == "analog", F.col("average")).alias("average"),
        F.when(b == "counter", F.col("delta")).alias("delta"),
        F.when(b == "state", F.col("distinct_counts")).alias("distinct_counts"),
        F.when(b.isin("smoke", "motion"), F.col("true_count")).alias("true_count"),
        score.alias("anomaly_score"))
