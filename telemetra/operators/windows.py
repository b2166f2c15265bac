"""Windowed aggregation per datastream with accumulating late re-firing.

Plan shape (batch replay):

1. ``classify_lateness``: window bounds + on_time / late_accepted / too_late.
2. Dedup by (datastream_id, window_start, seq), first arrival wins: a hash
   aggregate ``min(struct(arrival, row))`` - map-side combined, so even one key
   holding a large share of all rows is reduced before the shuffle.
3. Pane 1 of each window = on-time rows: a plain ``groupBy`` (partial + final).
4. Late rows (a small, bounded fraction) get running aggregates in arrival order
   per window; each one re-fires the window = pane 1 merged with its running state.

The on-time bulk never goes through a window function, so a hot stream does not
serialise into one sorted task; only its late rows are ordered.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.constants import WindowSpec
from telemetra.functions.timeparse import hms_label
from telemetra.operators.decode import evaluation_barrier
from telemetra.operators.eventtime import ARRIVAL, classify_lateness, late_records, window_start

KEY = ("datastream_id", "window_start")

RESULT_COLUMNS = (
    "datastream_id", "window", "count", "sensor_type", "metric", "window_start", "window_end",
    "result_time", "max_event_time", "max_publish_time", "latency", "end_to_end_latency",
    "fire_index", "is_late_firing",
    "first_value", "last_value", "delta",                       # counter
    "min_value", "max_value", "average",                        # analog
    "distinct_counts", "on_count", "off_count", "last_state",   # state (+ alarm distinct)
    "true_count", "false_count", "true_ratio", "triggered", "alarm_last_value",  # alarm
)


def _order_key(value: Column) -> Column:
    # (event time, arrival) ordering used for first/last: ties go to arrival order
    return F.struct(F.col("event_ms").alias("t"), F.col("arrival_ms").alias("am"),
                    F.col("arrival_seq").alias("aq"), value.alias("v"))


def _state_exprs() -> list[tuple[str, Column]]:
    """Mergeable per-window state (A1-A7) as (name, aggregate) pairs."""
    not_nan = F.when(~F.isnan("num"), F.col("num"))
    other_state = F.when(F.col("sensor_type").isin("state", "alarm")
                         & ~F.col("sval").isin("ON", "OFF"), F.col("sval"))
    return [
        ("n", F.count(F.lit(1))),
        ("max_ev", F.max("event_ms")),
        ("max_pub", F.max("publish_ms")),
        ("max_arr", F.max("arrival_ms")),
        ("first_row", F.min(F.struct(*[F.col(c) for c in ARRIVAL], F.col("sensor_type"),
                                     F.col("metric")))),
        ("vmin", F.min(not_nan)),
        ("vmax", F.max(not_nan)),
        ("vsum", F.sum("num")),
        ("cfirst", F.min(_order_key(F.col("num")))),
        ("clast", F.max(_order_key(F.col("num")))),
        ("on", F.count_if(F.col("sval") == "ON")),
        ("off", F.count_if(F.col("sval") == "OFF")),
        ("oset", F.collect_set(other_state)),
        ("slast", F.max(_order_key(F.col("sval")))),
        ("tc", F.count_if(F.col("bval"))),
        ("fc", F.count_if(~F.col("bval"))),
        ("alast", F.max(_order_key(F.col("bval")))),
    ]


def pane_aggregates() -> list[Column]:
    """State aggregates aliased by name, for ``groupBy().agg``."""
    return [e.alias(n) for n, e in _state_exprs()]


def running_aggregates(w) -> list[Column]:
    """The same state as running window aggregates."""
    return [e.over(w).alias(n) for n, e in _state_exprs()]


STATE = ("n", "max_ev", "max_pub", "max_arr", "first_row", "vmin", "vmax", "vsum", "cfirst",
         "clast", "on", "off", "oset", "slast", "tc", "fc", "alast")
_ADD = ("n", "on", "off", "tc", "fc")
_MAX = ("max_ev", "max_pub", "max_arr", "vmax", "clast", "slast", "alast")
_MIN = ("first_row", "vmin", "cfirst")


def merge_state(left: str, right: str) -> list[Column]:
    """Combine two partial states column-wise (``left``/``right`` are name prefixes)."""
    out = []
    for c in STATE:
        lc, rc = F.col(left + c), F.col(right + c)
        if c in _ADD:
            e = F.coalesce(lc, F.lit(0)) + F.coalesce(rc, F.lit(0))
        elif c in _MAX:
            e = F.greatest(lc, rc)
        elif c in _MIN:
            e = F.least(lc, rc)
        elif c == "vsum":
            e = F.when(lc.isNull(), rc).when(rc.isNull(), lc).otherwise(lc + rc)
        else:  # oset
            e = F.array_union(F.coalesce(lc, F.array().cast("array<string>")),
                              F.coalesce(rc, F.array().cast("array<string>")))
        out.append(e.alias(c))
    return out


def finalize(state: DataFrame, window_ms: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """A8 + A9: wide result row from state + ``pane`` + ``result_ms`` columns (+ ``keep``)."""
    st = F.col("first_row.sensor_type")
    is_ = lambda t: st == t
    n = F.col("n")
    max_ev = F.greatest(F.col("max_ev"), F.lit(0))
    max_pub = F.greatest(F.col("max_pub"), F.lit(0))
    res = F.col("result_ms")
    first_v = F.coalesce(F.col("cfirst.v"), F.lit(0.0))
    last_v = F.coalesce(F.col("clast.v"), F.lit(0.0))
    distinct_state = ((F.col("on") > 0).cast("bigint") + (F.col("off") > 0).cast("bigint")
                      + F.size("oset").cast("bigint"))
    distinct_alarm = (F.col("tc") > 0).cast("bigint") + (F.col("fc") > 0).cast("bigint")
    we = F.col("window_start") + F.lit(window_ms)
    return state.select(
        F.col("datastream_id"),
        hms_label(F.col("window_start"), we).alias("window"),
        n.alias("count"),
        st.alias("sensor_type"),
        F.col("first_row.metric").alias("metric"),
        F.col("window_start"),
        we.alias("window_end"),
        res.alias("result_time"),
        max_ev.alias("max_event_time"),
        max_pub.alias("max_publish_time"),
        F.when(max_ev > 0, res - max_ev).otherwise(F.lit(0)).alias("latency"),
        F.when(max_pub > 0, res - max_pub).otherwise(F.lit(0)).alias("end_to_end_latency"),
        F.col("pane").cast("int").alias("fire_index"),
        (F.col("pane") > 1).alias("is_late_firing"),
        F.when(is_("counter"), first_v).alias("first_value"),
        F.when(is_("counter"), last_v).alias("last_value"),
        F.when(is_("counter"), last_v - first_v).alias("delta"),
        F.when(is_("analog"), F.col("vmin")).alias("min_value"),
        F.when(is_("analog"), F.col("vmax")).alias("max_value"),
        F.when(is_("analog"), F.col("vsum") / n).alias("average"),
        F.when(is_("state"), distinct_state).when(is_("alarm"), distinct_alarm).alias("distinct_counts"),
        F.when(is_("state"), F.col("on")).alias("on_count"),
        F.when(is_("state"), F.col("off")).alias("off_count"),
        F.when(is_("state"), F.col("slast.v")).alias("last_state"),
        F.when(is_("alarm"), F.col("tc")).alias("true_count"),
        F.when(is_("alarm"), F.col("fc")).alias("false_count"),
        F.when(is_("alarm"), F.col("tc") / n).alias("true_ratio"),
        F.when(is_("alarm"), F.col("tc") > 0).alias("triggered"),
        F.when(is_("alarm"), F.col("alast.v")).alias("alarm_last_value"),
        *[F.col(c) for c in keep],
    )


def dedup_first_arrival(rows: DataFrame, keys=("datastream_id", "window_start", "seq")) -> DataFrame:
    """Keep the first arrival per key (hash aggregate with map-side combine)."""
    rest = [c for c in rows.columns if c not in keys and c not in ARRIVAL]
    packed = F.struct(*[F.col(c) for c in ARRIVAL], *[F.col(c) for c in rest])
    return (rows.groupBy(*keys).agg(F.min(packed).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (*ARRIVAL, *rest)]))


def panes(accepted: DataFrame, window_ms: int, flush: bool = True,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """One result row per firing from deduplicated, classified rows.

    ``carry`` columns of a late row are passed to the pane it fires (NULL on pane 1).
    """
    on = accepted.filter(F.col("lateness") == "on_time")
    late = accepted.filter(F.col("lateness") == "late_accepted")
    # a barrier, so that both readers of the base see one plan and its exchange is reused
    base = evaluation_barrier(on.groupBy(*KEY).agg(*pane_aggregates(), F.max("fire_arrival_ms").alias("fire_ms")))
    if not flush:  # end of bounded input does not fire windows the watermark never passed
        base = base.filter(F.col("fire_ms").isNotNull())
    first = base.select(*KEY, *STATE, F.lit(1).alias("pane"),
                        F.coalesce(F.col("fire_ms"), F.col("max_arr")).alias("result_ms"))
    order = [F.col(c) for c in ARRIVAL]
    running = Window.partitionBy(*KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = late.select(*KEY, *running_aggregates(running),
                      F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)).alias("j"),
                      F.col("arrival_ms").alias("result_ms"), *carry)
    run = run.select(*KEY, "j", "result_ms", *carry, *[F.col(c).alias("r_" + c) for c in STATE])
    b = base.select(*KEY, *[F.col(c).alias("b_" + c) for c in STATE])
    merged = run.join(b, list(KEY), "left").select(
        *KEY, *merge_state("b_", "r_"),
        (F.col("j") + F.when(F.col("b_n").isNotNull(), 1).otherwise(0)).alias("pane"),
        "result_ms", *carry)
    return finalize(first.unionByName(merged, allowMissingColumns=True), window_ms, carry)


def windowed_results(ok: DataFrame, spec: WindowSpec, flush: bool = True) -> tuple[DataFrame, DataFrame]:
    """Window results and late side output of the ok observations.

    Returns ``(results, late)``; ``results`` has ``RESULT_COLUMNS``.
    """
    cls = classify_lateness(ok, spec)
    late = late_records(cls, spec)
    # on-time and late rows are read from the same exchange: a filter pushed below it, or columns
    # pruned in one branch only, would run classification and dedup once for each branch
    accepted = evaluation_barrier(dedup_first_arrival(cls.filter(F.col("lateness") != "too_late")))
    return panes(accepted, spec.window_ms, flush), late


def plain_window_results(ok: DataFrame, window_ms: int) -> DataFrame:
    """Tumbling-window results without lateness (every window fires once at the end).

    Used as the minimum slice and as detector input. Dedup by seq within window.
    """
    rows = ok.withColumn("window_start", window_start(F.col("event_ms"), window_ms))
    acc = dedup_first_arrival(rows)
    state = acc.groupBy(*KEY).agg(*pane_aggregates())
    return finalize(state.select("*", F.lit(1).alias("pane"), F.col("max_arr").alias("result_ms")),
                    window_ms)


def late_firing_report(results: DataFrame) -> DataFrame:
    """One text line per late re-firing."""
    return results.filter(F.col("is_late_firing")).select(
        "datastream_id", "window_start", "fire_index",
        F.format_string("[LATE FIRING] key=%s metric=%s window=%s fire_index=%d",
                        "datastream_id", "metric", "window", "fire_index").alias("line"))
