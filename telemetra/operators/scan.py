"""Running (prefix) sums per key without putting a whole key into one sort.

``max/sum() OVER (PARTITION BY key ORDER BY o)`` sorts every row of a key in one
task. For additive measures the same result comes from two levels:

1. rows are split into ``(key, block)`` groups, ``block`` a coarse, order-monotone
   bucket of the ordering column (e.g. one day of result time); each group gets
   its local running sums (many small sorted partitions),
2. per ``(key, block)`` totals (one row per group, map-side combined) get an
   exclusive prefix sum over blocks - a tiny table,
3. the two are joined back on ``(key, block)``.

A hot key then spreads over as many tasks as it has blocks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def prefix_sums(df: DataFrame, key: list[str], order: list[str], block: Column,
                measures: dict[str, Column], inclusive: bool = False,
                extremes: dict[str, Column] | None = None) -> DataFrame:
    """Add ``<name>`` = sum of ``measures[name]`` over earlier rows of the key.

    ``order`` must be a total order within a key and ``block`` non-decreasing in
    it. ``inclusive`` also counts the current row. For each of ``extremes`` the
    columns ``<name>_lo`` and ``<name>_hi`` hold the smallest and largest earlier
    value (NULL without one).
    """
    hi = 0 if inclusive else -1
    ops = {n: (e, F.sum, lambda a, b: a + b, F.lit(0)) for n, e in measures.items()}
    for n, e in (extremes or {}).items():
        ops[f"{n}_lo"] = (e, F.min, F.least, F.lit(None))
        ops[f"{n}_hi"] = (e, F.max, F.greatest, F.lit(None))
    d = df.withColumn("_blk", block).select("*", *[op[0].alias(f"_m_{n}") for n, op in ops.items()])
    local_w = (Window.partitionBy(*key, "_blk").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, hi))
    local = d.select("*", *[F.coalesce(agg(f"_m_{n}").over(local_w), zero).alias(f"_l_{n}")
                            for n, (_, agg, _, zero) in ops.items()])
    totals = d.groupBy(*key, "_blk").agg(*[agg(f"_m_{n}").alias(f"_t_{n}") for n, (_, agg, _, _) in ops.items()])
    before = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*key, "_blk", *[F.coalesce(agg(f"_t_{n}").over(before), zero).alias(f"_o_{n}")
                                            for n, (_, agg, _, zero) in ops.items()])
    j = local.join(offsets, [*key, "_blk"], "left")
    return j.select(*df.columns, *[both(F.col(f"_l_{n}"), F.col(f"_o_{n}")).alias(n) for n, (_, _, both, _) in ops.items()])
