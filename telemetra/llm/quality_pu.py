"""Quality classifier by positive-unlabelled learning (non-negative risk).

Positives are trusted documents (label 1); unlabelled are any documents; label 0 is never
used. With class prior p the risk p E+[l(+)] + max(0, Eu[l(-)] - p E+[l(-)]) is minimised
over a small network on dense text features; where the second term turns negative the
step goes the other way (Kiryo et al. 2017).

**Class prior.** A logistic model is fitted to tell positives from unlabelled. For any set
of documents the prior is at most the ratio of its unlabelled to its positive share; the
smallest ratio over the sets {model >= t} of at least ``PRIOR_SHARE`` of the positives is
the estimate (Blanchard et al. 2010, Scott 2015), held inside [0.05, 0.98].

Fitted on a bounded, hash-chosen sample: ``POSITIVES`` trusted and ``UNLABELLED`` other
rows at most (parameters). Texts are turned into features inside Arrow batches and scored
whole; no shuffle. Null texts count as empty. Without a single positive every score is 0.5.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.llm import text_arrays as A
from telemetra.llm.common import slices

POSITIVES = 6000
UNLABELLED = 9000
HIDDEN = 16
EPOCHS = 60
PRIOR_SHARE = 0.2


def features(texts: list[str]) -> np.ndarray:
    """Dense features of each text (one row each): character classes, token shapes, repetition."""
    parts = [_features(texts[a:b]) for a, b in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


def _features(texts: list[str]) -> np.ndarray:
    t = A.TextArrays(texts)
    chars, tokens = np.maximum(t.length, 1), np.maximum(t.t_count, 1)
    share = t.char_counts / chars[:, None]
    letters = np.maximum(t.char_counts[:, A.LOWER] + t.char_counts[:, A.UPPER], 1)
    up, low, sign, digit, stop = (t.kinds_per_token(k) for k in (A.UPPER, A.LOWER, A.SIGN, A.DIGIT, A.STOP))
    of = lambda flags: t.per_text(flags) / tokens
    h = t.token_hash()
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (t.t_owner[1:] == t.t_owner[:-1])]) if len(h) else np.zeros(0, bool)
    three = h.copy()
    if len(h) > 2:
        inside = t.t_owner[2:] == t.t_owner[:-2]
        three[2:] = np.where(inside, h[2:] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[:-2] * np.uint64(7), h[2:])
    lines = t.char_counts[:, A.LINE] + 1
    mean = t.per_text(t.t_length) / tokens
    spread = np.sqrt(np.maximum(t.per_text(t.t_length.astype(float) ** 2) / tokens - mean ** 2, 0))
    only_sign = (sign > 0) & (up + low + digit == 0)
    return np.column_stack([
        share[:, A.LOWER], share[:, A.UPPER], share[:, A.DIGIT], share[:, A.SPACE], share[:, A.LINE], share[:, A.STOP],
        share[:, A.SIGN] * 5, share[:, A.OTHER], t.char_counts[:, A.UPPER] / letters,
        of((up > 1) & (low == 0)), of((sign > 0) & ~only_sign), of(only_sign), of(digit > 0), of(stop > 0), of(stop > 1),
        of(same), A.distinct_per_text(h, t.t_owner, t.n) / tokens,
        A.distinct_per_text(three, t.t_owner, t.n) / tokens, np.log1p(t.t_count) / 8, np.log1p(lines) / 5,
        np.log1p(tokens / lines) / 6, mean / 10, spread / 10, (t.t_count == 0).astype(float)])


N_FEATURES = 24


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float


def _normal(x: np.ndarray, m: Model) -> np.ndarray:
    return np.clip((x - m.centre) / m.scale, -6, 6)


def decision(m: Model, x: np.ndarray) -> np.ndarray:
    return np.tanh(_normal(x, m) @ m.w1 + m.b1) @ m.w2 + m.b2


def probability(m: Model | None, x: np.ndarray) -> np.ndarray:
    if m is None:
        return np.full(len(x), 0.5)
    return 1 / (1 + np.exp(-np.clip(decision(m, x), -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows (normalised features)."""
    x = np.concatenate([positive, unlabelled])
    y = np.concatenate([np.ones(len(positive)), np.zeros(len(unlabelled))])
    weight = np.where(y == 1, 0.5 / len(positive), 0.5 / len(unlabelled))
    x1 = np.column_stack([x, x ** 2, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(25):                      # ridge Newton steps
        q = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ ((q - y) * weight) + 1e-3 * w
        hess = (x1 * (weight * q * (1 - q))[:, None]).T @ x1 + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    s, u = np.sort(x1[:len(positive)] @ w), np.sort(x1[len(positive):] @ w)
    cuts = s[: max(1, int(len(s) * (1 - PRIOR_SHARE)))]
    in_p = 1 - np.arange(len(cuts)) / len(s)
    in_u = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    slack = np.sqrt(in_p * (1 - in_p) / len(s)) + np.sqrt(in_u * (1 - in_u) / len(u))
    return float(np.clip(((in_u + slack) / in_p).min(), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 11, prior: float | None = None) -> Model | None:
    """Non-negative PU training with Adam; ``prior`` is estimated unless given."""
    if not len(positive) or not len(unlabelled):
        return None
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    scale = both.std(0)
    m = Model(both.mean(0), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 0.3, (both.shape[1], HIDDEN)),
              np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), 0.0, 0.5)
    p, u = _normal(positive, m), _normal(unlabelled, m)
    m.prior = estimate_prior(p, u) if prior is None else prior
    params = [m.w1, m.b1, m.w2, np.array([m.b2])]
    first, second, step = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params], 0

    def gradients(x: np.ndarray, per_row: np.ndarray) -> list[np.ndarray]:
        h = np.tanh(x @ params[0] + params[1])
        back = per_row[:, None] * params[2] * (1 - h ** 2)
        return [x.T @ back, back.sum(0), h.T @ per_row, np.array([per_row.sum()])]

    def score(x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ params[0] + params[1]) @ params[2] + params[3][0]

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    rounds = max(4, min(len(p), len(u)) // 256)
    for _ in range(EPOCHS):
        for bp, bu in zip(np.array_split(rng.permutation(len(p)), rounds), np.array_split(rng.permutation(len(u)), rounds)):
            if not len(bp) or not len(bu):
                continue
            sp, su = score(p[bp]), score(u[bu])
            negative = np.logaddexp(0, su).mean() - m.prior * np.logaddexp(0, sp).mean()
            g_minus = [a - b for a, b in zip(gradients(u[bu], sigmoid(su) / len(bu)),
                                             gradients(p[bp], m.prior * sigmoid(sp) / len(bp)))]
            if negative < 0:
                g = [-x for x in g_minus]
            else:
                g = [a + b for a, b in zip(g_minus, gradients(p[bp], m.prior * (sigmoid(sp) - 1) / len(bp)))]
            step += 1
            for i, x in enumerate(params):
                d = g[i] + 1e-4 * x
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.999 * second[i] + 0.001 * d * d
                x -= 0.005 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3][0])
    return m


def bounded(df: DataFrame, key: str, limit: int, seed: str) -> DataFrame:
    """At most about ``limit`` rows of ``df``, those of the smallest hashes of ``key``."""
    n = df.count()
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30))
    return df if n <= limit else df.filter(draw < int((1 << 30) * limit / n))


def feature_rows(df: DataFrame, text: str) -> np.ndarray:
    """Features of a bounded table; computed in tasks, gathered on the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "x": list(features(["" if t is None else t for t in b["text"]]))})
    rows = df.select(F.xxhash64(text).alias("h"), F.col(text).alias("text")).mapInPandas(run, "h long, x array<double>").collect()
    return np.array([r["x"] for r in sorted(rows, key=lambda r: r["h"])]).reshape(len(rows), N_FEATURES)


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """``trusted``: ids of positive documents; ``docs``: the documents that may be used."""
    ids = bounded(trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct(), "_id", positives, "positive")
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    positive = chosen.join(F.broadcast(ids), "_id", "left_semi")      # at most about `positives` ids
    return fit(feature_rows(positive, "_text"), feature_rows(bounded(chosen, "_id", unlabelled, "unlabelled"), "_text"))


def scored(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Score column of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(probability(shared.value, features(["" if t is None else t for t in s])))
    return run(text)
