"""Gradient-boosted regression trees on binned features (logistic loss),
small enough to be fitted on a bounded sample and sent to tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Complete binary trees of one depth: ``feature`` and ``cut`` per inner
    node (a row goes right if its value is above the cut), ``value`` per leaf."""

    base: float
    feature: np.ndarray     # (trees, 2**depth - 1)
    cut: np.ndarray
    value: np.ndarray       # (trees, 2**depth)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int32)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2,
        least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Newton boosting; each level's best cuts come from histograms of the
    gradients over at most BINS quantile bins a feature."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = np.log(p / (1 - p))
    score, inner = np.full(n, base), 2**depth - 1
    features, cuts, values = [], [], []
    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-score))
        g, h = y - prob, prob * (1 - prob) + 1e-9
        feature, cut = np.zeros(inner, np.int32), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = node - first
            whole_g, whole_h = np.bincount(slot, g, width), np.bincount(slot, h, width)
            best = np.full(width, 1e-6)
            for j in range(d):
                key = slot * BINS + binned[:, j]
                lg = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(1)
                lh = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(1)
                rg, rh = whole_g[:, None] - lg, whole_h[:, None] - lh
                gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - (whole_g**2 / (whole_h + ridge))[:, None]
                gain[(lh < least) | (rh < least)] = 0
                gain[:, len(edges[j]):] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], cut[first + k] = top[k], j, edges[j][at[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        score += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(float(base), np.array(features), np.array(cuts), np.array(values))
