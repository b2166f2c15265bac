"""Half-space trees (Tan, Ting & Liu, IJCAI 2011) as fixed split tables.

Trees are data: for each detector branch, ``n_trees`` complete binary trees of
``height`` levels of splits in heap order (node i has children 2i+1 and 2i+2;
internal nodes 0 .. 2^height - 2, leaves after them). Every internal node splits
one feature of the branch at a random point in the middle 70 % of the node's
range, starting from the ``[-limit, limit]`` box of standardised features.
They are built once on the driver from a seed (25 x 63 splits per branch: a
fixed, data-independent size) and reused by the relational scorer and by the
sequential per-stream detector.

Score of a sample (before it is learned) against the previous completed window
of ``window`` samples: walk root to leaf adding ``mass * 2^depth`` and stop after
the first node whose mass is below ``0.1 * window``; then
``1 - total / (n_trees * window * (2^(height+1) - 1))``. The first window scores 0.
"""
from __future__ import annotations

import random
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from telemetra.constants import FEATURES, HST_HEIGHT, HST_LIMIT, HST_SEED, HST_TREES, HST_WINDOW

PADDING = 0.15   # splits fall in the middle 70 % of a node's range


@dataclass(frozen=True)
class Forest:
    branch: str
    n_features: int
    feats: tuple[tuple[int, ...], ...]      # [tree][internal node] -> feature index
    thrs: tuple[tuple[float, ...], ...]     # [tree][internal node] -> threshold
    height: int = HST_HEIGHT
    window: int = HST_WINDOW

    @property
    def n_trees(self) -> int:
        return len(self.feats)

    @property
    def n_nodes(self) -> int:
        return 2 ** (self.height + 1) - 1

    @property
    def size_limit(self) -> float:
        return 0.1 * self.window

    @property
    def max_score(self) -> float:
        return float(self.n_trees * self.window * self.n_nodes)


def build_forest(branch: str, n_features: int, n_trees: int = HST_TREES, height: int = HST_HEIGHT,
                 seed: int = HST_SEED, limit: float = HST_LIMIT) -> Forest:
    rng = random.Random(seed)
    n_internal = 2 ** height - 1
    feats, thrs = [], []
    for _ in range(n_trees):
        f = [0] * n_internal
        t = [0.0] * n_internal

        def grow(node: int, box: list[tuple[float, float]]) -> None:
            if node >= n_internal:
                return
            k = rng.randrange(n_features)
            a, b = box[k]
            at = rng.uniform(a + PADDING * (b - a), b - PADDING * (b - a))
            f[node], t[node] = k, at
            left, right = list(box), list(box)
            left[k], right[k] = (a, at), (at, b)
            grow(2 * node + 1, left)
            grow(2 * node + 2, right)

        grow(0, [(-limit, limit)] * n_features)
        feats.append(tuple(f))
        thrs.append(tuple(t))
    return Forest(branch, n_features, tuple(feats), tuple(thrs), height)


@lru_cache(maxsize=None)
def forest(branch: str) -> Forest:
    return build_forest(branch, len(FEATURES[branch]))


BRANCHES = tuple(FEATURES)


# --------------------------------------------------------------------------- numpy form

@lru_cache(maxsize=None)
def split_tables(branch: str) -> tuple[np.ndarray, np.ndarray]:
    fr = forest(branch)
    return np.asarray(fr.feats), np.asarray(fr.thrs)


def node_keys(branch: str, z: np.ndarray) -> np.ndarray:
    """Nodes that samples (rows, features) visit: ``tree * n_nodes + node``, shape (rows, trees, height + 1)."""
    fr, (feats, thrs) = forest(branch), split_tables(branch)
    rows, trees = np.arange(len(z))[:, None], np.arange(fr.n_trees)[None, :]
    keys = np.empty((len(z), fr.n_trees, fr.height + 1), dtype=np.int64)
    node = np.zeros((len(z), fr.n_trees), dtype=np.int64)
    keys[:, :, 0] = trees * fr.n_nodes
    for d in range(1, fr.height + 1):
        node = 2 * node + 1 + (z[rows, feats[trees, node]] >= thrs[trees, node])
        keys[:, :, d] = trees * fr.n_nodes + node
    return keys


def mass_scores(fr: Forest, m: np.ndarray) -> np.ndarray:
    """Scores of samples whose nodes have masses ``m`` (rows, trees, height + 1).

    Masses only shrink down a path (a sample that reaches a node passed its parent), so
    "stop after the first node below the size limit" is "a node counts when it is the root
    or its parent's mass reaches the limit".
    """
    counts = np.ones(m.shape, dtype=bool)
    counts[:, :, 1:] = m[:, :, :-1] >= fr.size_limit
    return 1.0 - (m * counts * (2 ** np.arange(m.shape[2]))).sum((1, 2)) / fr.max_score


def path_keys_batch(branches: np.ndarray, zs: list) -> list[np.ndarray]:
    """Per sample the ``trees * (height + 1)`` node keys in (tree, depth) order."""
    out: list[np.ndarray | None] = [None] * len(zs)
    for b in np.unique(branches):
        idx = np.flatnonzero(branches == b)
        flat = node_keys(b, np.vstack([np.asarray(zs[i], dtype=float) for i in idx])).reshape(len(idx), -1)
        for j, i in enumerate(idx):
            out[i] = flat[j]
    return out
