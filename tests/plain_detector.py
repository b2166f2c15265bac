"""Row-by-row detector, the plain form that the array form is held against."""
from __future__ import annotations

import math

import numpy as np

from telemetra.constants import (ADWIN_CLOCK, ADWIN_DELTA, ADWIN_GRACE, ADWIN_MIN_WINDOW, ANOMALY_THRESHOLD, DRIFT_COOLDOWN,
                                 MIN_SAMPLES_FOR_ANOMALY, MIN_SAMPLES_FOR_DRIFT)
from telemetra.operators.detector import MAX_FEATURES, Z_DIGITS
from telemetra.operators.hst import BRANCHES, Forest, forest


class Adwin:
    def __init__(self, delta: float = ADWIN_DELTA, clock: int = ADWIN_CLOCK,
                 grace_period: int = ADWIN_GRACE, min_window_length: int = ADWIN_MIN_WINDOW,
                 max_buckets: int = 5):
        self.delta, self.clock = delta, clock
        self.grace_period, self.min_window_length = grace_period, min_window_length
        self.max_buckets = max_buckets
        self.rows: list[list[tuple[float, float]]] = []   # row i: buckets of 2^i values, oldest first
        self.width = 0
        self.total = 0.0
        self.variance = 0.0
        self.ticks = 0
        self.drift_detected = False

    # -- state -------------------------------------------------------------------
    def _insert(self, x: float) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[0].append((x, 0.0))
        if self.width > 0:
            mean = self.total / self.width
            self.variance += self.width * (x - mean) ** 2 / (self.width + 1)
        self.width += 1
        self.total += x
        i = 0
        while i < len(self.rows) and len(self.rows[i]) > self.max_buckets:
            (t1, v1), (t2, v2) = self.rows[i][0], self.rows[i][1]
            n = 2 ** i
            merged = (t1 + t2, v1 + v2 + n * n * ((t1 / n - t2 / n) ** 2) / (2 * n))
            del self.rows[i][:2]
            if i + 1 == len(self.rows):
                self.rows.append([])
            self.rows[i + 1].append(merged)
            i += 1

    def _drop_oldest(self) -> None:
        i = len(self.rows) - 1
        while i >= 0 and not self.rows[i]:
            i -= 1
        t, v = self.rows[i].pop(0)
        n = 2 ** i
        self.width -= n
        self.total -= t
        if self.width > 0:
            mean_rest = self.total / self.width
            self.variance -= v + n * self.width * ((t / n - mean_rest) ** 2) / (n + self.width)
            self.variance = max(self.variance, 0.0)
        else:
            self.variance = 0.0
        while self.rows and not self.rows[-1]:
            self.rows.pop()

    # -- test --------------------------------------------------------------------
    def _cut_found(self) -> bool:
        if self.width < 2 * self.min_window_length:
            return False
        var = self.variance / self.width
        ln_term = math.log(2.0 * math.log(self.width) / self.delta)
        n0, t0 = 0, 0.0
        # walk buckets from oldest to newest; older part grows
        for i in range(len(self.rows) - 1, -1, -1):
            for t, _ in self.rows[i]:
                n0 += 2 ** i
                t0 += t
                n1 = self.width - n0
                if n1 < self.min_window_length:
                    return False
                if n0 < self.min_window_length:
                    continue
                m = 1.0 / n0 + 1.0 / n1
                eps = math.sqrt(2.0 * m * var * ln_term) + 2.0 / 3.0 * m * ln_term
                if abs(t0 / n0 - (self.total - t0) / n1) > eps:
                    return True
        return False

    def update(self, x: float) -> None:
        self.drift_detected = False
        self._insert(float(x))
        self.ticks += 1
        if self.ticks % self.clock != 0 or self.width <= self.grace_period:
            return
        while self._cut_found():
            self._drop_oldest()
            self.drift_detected = True


class Scaler:
    """Running mean and variance (Welford); z is 0 without history or where all of it is equal."""

    def __init__(self, width: int):
        self.c = 0
        self.mean = np.zeros(width)
        self.m2 = np.zeros(width)
        self.lo = np.full(width, np.inf)
        self.hi = np.full(width, -np.inf)

    def transform(self, x: np.ndarray) -> np.ndarray:
        varies = self.hi > self.lo
        sd = np.sqrt(np.where(varies, self.m2 / max(self.c, 1), 1.0))
        return np.round(np.where(varies & (sd > 0), (x - self.mean) / np.where(sd > 0, sd, 1.0), 0.0), Z_DIGITS)

    def learn(self, x: np.ndarray) -> None:
        self.c += 1
        d = x - self.mean
        self.mean = self.mean + d / self.c
        self.m2 = self.m2 + d * (x - self.mean)
        self.lo, self.hi = np.minimum(self.lo, x), np.maximum(self.hi, x)


def paths(fr: Forest, z: np.ndarray) -> np.ndarray:
    """Node ids on the root-to-leaf path of ``z`` in every tree: shape (trees, height+1)."""
    out = np.zeros((fr.n_trees, fr.height + 1), dtype=np.int64)
    feats = np.asarray(fr.feats)
    thrs = np.asarray(fr.thrs)
    node = np.zeros(fr.n_trees, dtype=np.int64)
    rows = np.arange(fr.n_trees)
    for d in range(1, fr.height + 1):
        go_right = z[feats[rows, node]] >= thrs[rows, node]
        node = 2 * node + 1 + go_right.astype(np.int64)
        out[:, d] = node
    return out


class HalfSpaceTrees:
    """Sequential model: score_one before learn_one, mass windows swap every ``window``."""

    def __init__(self, fr: Forest):
        self.fr = fr
        self.ref = np.zeros((fr.n_trees, fr.n_nodes), dtype=np.int64)
        self.latest = np.zeros_like(self.ref)
        self.counter = 0
        self.first_window = True

    def score_one(self, z: np.ndarray) -> float:
        if self.first_window:
            return 0.0
        p = paths(self.fr, z)
        rows = np.arange(self.fr.n_trees)[:, None]
        m = self.ref[rows, p]                                   # (trees, depth)
        below = m < self.fr.size_limit
        # keep depths up to and including the first node below the size limit
        stop = np.where(below.any(axis=1), below.argmax(axis=1), self.fr.height)
        keep = np.arange(self.fr.height + 1)[None, :] <= stop[:, None]
        total = float((m * (2 ** np.arange(self.fr.height + 1))[None, :] * keep).sum())
        return 1.0 - total / self.fr.max_score

    def learn_one(self, z: np.ndarray) -> None:
        p = paths(self.fr, z)
        rows = np.arange(self.fr.n_trees)[:, None]
        np.add.at(self.latest, (np.broadcast_to(rows, p.shape), p), 1)
        self.counter += 1
        if self.counter == self.fr.window:
            self.ref, self.latest = self.latest, np.zeros_like(self.latest)
            self.counter = 0
            self.first_window = False


class Entry:
    def __init__(self, reset_count=0):
        self.count, self.drift, self.reset_count, self.cooldown = 0, Adwin(), reset_count, 0
        self.branch = self.scaler = self.model = None

    def use(self, branch):
        self.branch, self.scaler, self.model = branch, Scaler(forest(branch).n_features), HalfSpaceTrees(forest(branch))


def run(rows, threshold=ANOMALY_THRESHOLD):
    """Events (kind, time_ms, score or drift value, n or count before the reset, reset_count) of one stream's
    feature rows in order, and the final (count, reset_count)."""
    e, out = Entry(), []
    for r in rows:
        b = r["branch"]
        if b == "fault":
            out.append(("anomaly", r["window_end"], 1.0, e.count, e.reset_count))
            continue
        if b == "smoke":
            e.count += 1
            out.append(("anomaly", r["window_end"], 1.0, e.count, e.reset_count))
            continue
        if e.branch != b:
            e.use(b)
        x = np.array([r[f"f{i}"] for i in range(forest(b).n_features)], dtype=float)
        score = e.model.score_one(e.scaler.transform(x))
        e.scaler.learn(x)
        e.model.learn_one(e.scaler.transform(x))
        e.count += 1
        if e.cooldown > 0:
            e.cooldown -= 1
        elif e.count >= MIN_SAMPLES_FOR_DRIFT:
            e.drift.update(score)
            if e.drift.drift_detected:
                out.append(("drift", r["window_end"], score, e.count, e.reset_count + 1))
                e = Entry(e.reset_count + 1)
                e.cooldown = DRIFT_COOLDOWN
        if score > threshold and e.count >= MIN_SAMPLES_FOR_ANOMALY:
            out.append(("anomaly", r["window_end"], score, e.count, e.reset_count))
    return out, (e.count, e.reset_count)
