"""Gradient-boosted trees and isotonic calibration for bounded training sets.

Training runs in numpy on a bounded sample of feature rows (callers document
the bound); scoring is row-wise and vectorised, so it runs inside Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Trees:
    """Complete binary trees of one depth: node k has children 2k+1 and 2k+2."""

    prior: float
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 60, depth: int = 4,
              rate: float = 0.15, l2: float = 2.0) -> Trees:
    """Logistic-loss boosting on histogram bins. One class alone gives its prior."""
    weight = np.ones(len(y)) if weight is None else weight
    total = weight.sum()
    mean = float((weight * y).sum() + 0.5) / float(total + 1.0)
    model = Trees(float(np.log(mean / (1 - mean))), depth)
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    score = np.full(len(y), model.prior)
    for _ in range(rounds):
        p = sigmoid(score)
        grad, hess = weight * (y - p), weight * p * (1 - p)
        inner = 2 ** depth - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, n = 2 ** level - 1, 2 ** level
            node = at - first
            best = np.full(n, 1e-6)
            split_bin = np.full(n, BINS)
            for f, bins in enumerate(binned):
                key = node * BINS + bins
                g = np.bincount(key, grad, n * BINS).reshape(n, BINS)
                h = np.bincount(key, hess, n * BINS).reshape(n, BINS)
                gl, hl = g.cumsum(1), h.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[:, len(edges[f]):] = -1.0
                k = gain.argmax(1)
                top = gain[np.arange(n), k]
                better = top > best
                best[better], split_bin[better] = top[better], k[better]
                feature[first:first + n][better] = f
            for j in range(n):
                if split_bin[j] < BINS:
                    cut[first + j] = edges[feature[first + j]][split_bin[j]]
            f = feature[at]
            at = 2 * at + 1 + (binned[f, np.arange(len(y))] > split_bin[node])
        leaf_of = at - inner
        g, h = np.bincount(leaf_of, grad, 2 ** depth), np.bincount(leaf_of, hess, 2 ** depth)
        leaf = rate * g / (h + l2)
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(leaf)
        score += leaf[leaf_of]
    return model


@dataclass
class Isotonic:
    """A non-decreasing map from raw scores to frequencies, linear between knots."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y)


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators. Equal raw scores form one block. Frequencies are
    smoothed by one half of a row in each class, so none is 0 or 1."""
    if len(raw) == 0:
        return Isotonic(np.array([-1.0, 1.0]), sigmoid(np.array([-1.0, 1.0])))
    values, inverse = np.unique(raw, return_inverse=True)
    n = np.bincount(inverse).astype(float)
    s = np.bincount(inverse, y)
    blocks: list[list[float]] = []   # rows, positives, first value, last value
    for v, a, b in zip(values.tolist(), n.tolist(), s.tolist(), strict=True):
        blocks.append([a, b, v, v])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            a2, b2, _, last = blocks.pop()
            blocks[-1][0] += a2
            blocks[-1][1] += b2
            blocks[-1][3] = last
    xs, ys = [], []
    for a, b, lo, hi in blocks:
        f = (b + 0.5) / (a + 1.0)
        xs += [lo, hi] if hi > lo else [lo]
        ys += [f, f] if hi > lo else [f]
    return Isotonic(np.array(xs), np.maximum.accumulate(np.array(ys)))
