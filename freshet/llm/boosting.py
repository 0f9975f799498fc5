"""Gradient boosted trees for a yes-or-no label, on histograms of the features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

BINS, DEPTH, ROUNDS, RATE, LEAF, RIDGE = 32, 3, 60, 0.2, 5.0, 1.0


@dataclass
class Trees:
    """Complete trees of one depth; a row goes right where its feature exceeds the limit."""

    bias: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    limit: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - len(feature)]
        return total


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    trees = Trees(bias=float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return trees
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), trees.bias)
    inner = 2**DEPTH - 1
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == at)
                best = 1e-6
                gs, hs = g[mine].sum(), h[mine].sum()
                for j, c in enumerate(cuts):
                    if not len(c) or not len(mine):
                        continue
                    gl = np.cumsum(np.bincount(binned[mine, j], g[mine], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[mine, j], h[mine], len(c) + 1))[:-1]
                    nl = np.cumsum(np.bincount(binned[mine, j], minlength=len(c) + 1))[:-1]
                    gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(nl < LEAF) | (len(mine) - nl < LEAF)] = 0.0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[at], limit[at] = gain[k], j, c[k]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + RIDGE)
        margin += value[leaf]
        trees.feature.append(feature)
        trees.limit.append(limit)
        trees.value.append(value)
    return trees


#: Gradients are added as whole numbers of this fraction, so that the order of adding plays no part.
UNIT = 1 << 20


def cut_points(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Limits between the bins of a feature, from how often each value occurs."""
    order = np.argsort(values, kind="stable")
    places = np.searchsorted(np.cumsum(counts[order]), np.linspace(0, 1, BINS)[1:-1] * counts.sum(), side="left")
    return np.unique(values[order][places])


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def of_bins(bins: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """A value of each bin: trees cannot tell it from the others there."""
    return np.stack([np.append(c, c[-1] + 1.0)[bins[:, j]] for j, c in enumerate(cuts)], axis=1)


def histogram(x: np.ndarray, bins: np.ndarray, label: np.ndarray, count: np.ndarray, margin: np.ndarray, path: list) -> np.ndarray:
    """Gradient, curvature and rows by node, feature and bin, as whole numbers; ``path`` has the splits above."""
    p = 1 / (1 + np.exp(-margin))
    g = np.rint((p - label) * UNIT).astype(np.int64) * count
    h = np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT).astype(np.int64) * count
    node = np.zeros(len(x), dtype=np.int64)
    for feature, limit in path:
        node = 2 * node + (x[np.arange(len(x)), feature[node]] > limit[node])
    shape = (2 ** len(path), x.shape[1], BINS)
    at = ((node[:, None] * shape[1] + np.arange(shape[1])) * BINS + bins).ravel()
    out = np.zeros((3, int(np.prod(shape))), dtype=np.int64)
    for k, v in enumerate((g, h, count)):
        np.add.at(out[k], at, np.repeat(v, shape[1]))
    return out.reshape(3, *shape)


def grow(cuts: list[np.ndarray], rows: int, positive: int, sums: Callable[[Trees, list], np.ndarray]) -> Trees:
    """As ``fit``, over rows that lie anywhere: ``sums(trees, path)`` adds up ``histogram`` over all of them."""
    share = (positive + 1.0) / (rows + 2.0)
    trees = Trees(bias=float(np.log(share / (1 - share))))
    if not 0 < positive < rows:
        return trees
    for _ in range(ROUNDS):
        path: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(DEPTH):
            total = sums(trees, path)
            g, h, n = (np.cumsum(t, axis=2) for t in (total[0] / UNIT, total[1] / UNIT, total[2]))
            feature, limit = np.zeros(2**level, dtype=np.int64), np.full(2**level, np.inf)
            leaves = np.zeros((2, 2 ** (level + 1)))
            for at in range(2**level):
                best, gs, hs = 1e-6, g[at, 0, -1], h[at, 0, -1]
                leaves[:, 2 * at] = gs, hs
                for j, c in enumerate(cuts):
                    gl, hl, nl = g[at, j, : len(c)], h[at, j, : len(c)], n[at, j, : len(c)]
                    gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(nl < LEAF) | (n[at, j, -1] - nl < LEAF)] = 0.0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[at], limit[at] = gain[k], j, c[k]
                        leaves[:, 2 * at : 2 * at + 2] = [[gl[k], gs - gl[k]], [hl[k], hs - hl[k]]]
            path.append((feature, limit))
        trees.feature.append(np.concatenate([f for f, _ in path]))
        trees.limit.append(np.concatenate([c for _, c in path]))
        trees.value.append(-RATE * leaves[0] / (leaves[1] + RIDGE))
    return trees
