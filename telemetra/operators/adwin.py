"""ADWIN change detector (Bifet & Gavalda, SDM 2007) over arrays of values.

The detector restarts after every change, so until one is found no value is ever dropped and
its buckets depend on the number of values alone: at most ``MAX_BUCKETS`` of 2^i values a row,
the two oldest of a row that overflows are merged into the next. The borders of the buckets
are therefore known prefix lengths, and a split's two means are differences of prefix sums.
Every ``ADWIN_CLOCK`` values, once more than ``ADWIN_GRACE`` have been seen, every border that
leaves ``ADWIN_MIN_WINDOW`` values on either side is tested with

    eps = sqrt(2 * m * var * ln(2 * ln(n) / delta)) + 2/3 * m * ln(2 * ln(n) / delta),
    m = 1/n0 + 1/n1.

Between calls only the sums at the current borders are kept: a few per doubling of the length.
"""
from __future__ import annotations

import numpy as np

from telemetra.constants import ADWIN_CLOCK, ADWIN_DELTA, ADWIN_GRACE, ADWIN_MIN_WINDOW

MAX_BUCKETS = 5


def bucket_borders(n: int) -> np.ndarray:
    """Prefix lengths at which buckets meet after ``n`` values, ascending, without 0 and ``n``."""
    ends, newer, size, left = [], 0, 1, n
    while left:
        buckets = left if left <= MAX_BUCKETS else MAX_BUCKETS - 1 + left % 2
        for _ in range(buckets):
            newer += size
            ends.append(n - newer)
        left, size = (left - buckets) // 2, 2 * size
    return np.array(ends[::-1][1:], dtype=np.int64)


def fresh() -> dict:
    """State before the first value: length, sum, sum of squares, borders and the sums up to them."""
    return {"n": 0, "total": 0.0, "squares": 0.0, "borders": np.zeros(0, np.int64), "sums": np.zeros(0)}


def cut_found(n: int, total: float, squares: float, borders: np.ndarray, sums: np.ndarray) -> bool:
    ok = (borders >= ADWIN_MIN_WINDOW) & (n - borders >= ADWIN_MIN_WINDOW)
    n0, t0 = borders[ok], sums[ok]
    if not len(n0):
        return False
    n1 = n - n0
    var, ln_term = max(squares / n - (total / n) ** 2, 0.0), np.log(2.0 * np.log(n) / ADWIN_DELTA)
    m = 1.0 / n0 + 1.0 / n1
    eps = np.sqrt(2.0 * m * var * ln_term) + 2.0 / 3.0 * m * ln_term
    return bool((np.abs(t0 / n0 - (total - t0) / n1) > eps).any())


def advance(state: dict, x: np.ndarray) -> tuple[int, dict]:
    """(index in ``x`` of the value at which a change is found, or -1; the state after all of ``x``)."""
    if not len(x):
        return -1, state
    start, end = state["n"], state["n"] + len(x)
    # summed one by one from the state on: the sums don't depend on how the values are cut into calls
    total, squares = (np.cumsum(np.concatenate([[state[k]], v]))[1:] for k, v in (("total", x), ("squares", x * x)))
    places = np.concatenate([state["borders"], np.arange(start, end + 1)])
    sums = np.concatenate([state["sums"], [state["total"]], total])

    def up_to(borders: np.ndarray) -> np.ndarray:
        return sums[np.searchsorted(places, borders)]
    for n in range(start - start % ADWIN_CLOCK + ADWIN_CLOCK, end + 1, ADWIN_CLOCK):
        i = n - start - 1
        if n > ADWIN_GRACE:
            borders = bucket_borders(n)
            if cut_found(n, total[i], squares[i], borders, up_to(borders)):
                return i, state
    borders = bucket_borders(end)
    return -1, {"n": end, "total": float(total[-1]), "squares": float(squares[-1]), "borders": borders, "sums": up_to(borders)}
