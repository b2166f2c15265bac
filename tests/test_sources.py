"""Watermark over several sources with silent ones (E3) against a record-by-record replay."""
import random

import pytest

from telemetra.constants import WindowSpec
from telemetra.operators import sources
from telemetra.operators.sources import idle_thresholds

SPEC = WindowSpec(10, 3, 15)
COLUMNS = "source string, event_ms bigint, arrival_ms bigint, arrival_seq bigint"


def replay(rows, idle):
    """First (arrival, seq) at which the watermark has passed each window's end, and its end + lateness."""
    moments = sorted({(a, q) for _, _, a, q in rows} | {(a + idle, -1) for _, _, a, _ in rows})
    at = {(a, q): (s, e) for s, e, a, q in rows}
    top, heard, steps = {}, {}, []
    for ms, seq in moments:
        if (ms, seq) in at:
            s, e = at[ms, seq]
            top[s], heard[s] = max(top.get(s, e), e), ms
        live = [top[s] for s in top if ms - heard[s] < idle]
        if live:
            steps.append(((ms, seq), min(live) - SPEC.bound_ms - 1))
    out = {}
    for _, e, _, _ in rows:
        start = e // SPEC.window_ms * SPEC.window_ms
        end = start + SPEC.window_ms
        first = lambda limit: next((p for p, w in steps if w >= limit), None)
        out[start // SPEC.window_ms] = (first(end - 1), first(end + SPEC.lateness_ms))
    return out


def found(spark, rows, idle):
    thr = idle_thresholds(spark.createDataFrame(rows, COLUMNS).repartition(4), SPEC, idle).filter("n_rows > 0")
    return {r["widx"]: tuple(p and tuple(p) for p in (r["fire_at"], r["expire_at"])) for r in thr.collect()}


@pytest.mark.parametrize("seed, blocks", [(1, 512), (2, 1), (3, 2)])
def test_equals_replay(spark, monkeypatch, seed, blocks):
    monkeypatch.setattr(sources, "BLOCK_WINDOWS", blocks)
    rng, rows, t = random.Random(seed), [], 0
    for i in range(260):
        t += rng.choice([0, 1, 1, 2, 6]) if i % 60 else 45
        s = rng.choice("aab") if (t // 70) % 2 else rng.choice("abc")          # c is silent now and then
        rows.append((s, t + rng.randrange(-12, 4) - (8 if s == "b" else 0), t, i))
    assert found(spark, rows, 20) == replay(rows, 20)


def test_a_silent_source_lets_go(spark):
    rows = [("a", 1, 1, 0), ("b", 2, 2, 1)] + [("a", i, i, i) for i in range(3, 80)]
    got = found(spark, rows, 20)
    assert got == replay(rows, 20)
    assert got[0][0] == (22, -1)                        # b's last record was at 2: it holds the watermark until 22
    alone = found(spark, [r for r in rows if r[0] == "a"], 20)
    assert alone[0][0] == (13, 13)


def test_empty(spark):
    assert idle_thresholds(spark.createDataFrame([], COLUMNS), SPEC, 20).isEmpty()


def test_rows_of_one_row_group_are_dealt_over_all_tasks(spark, tmp_path):
    """A file of more splits than cores whose rows lie in one row group: every task gets its share."""
    from telemetra.fixtures.feed import ROWS_PER_TASK, spread, tasks_for
    spark.range(4000).selectExpr("id as event_id", "uuid() as props").coalesce(1).write.parquet(str(tmp_path / "events"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, "1k")
        df = spark.read.parquet(str(tmp_path / "events"))
        cores = spark.sparkContext.defaultParallelism
        assert df.rdd.getNumPartitions() >= cores
        sizes = spread(df).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and len(sizes) == cores and max(sizes) <= 2 * 4000 / cores
    # beyond that the number of tasks grows with the rows
    assert tasks_for(1000 * ROWS_PER_TASK, cores) == 1000 and tasks_for(0, cores) == cores
