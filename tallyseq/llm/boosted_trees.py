"""Gradient-boosted decision trees for two classes, on histograms of binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class BoostedTrees:
    """Complete trees of one depth: per tree a feature and a threshold for each inner node and a value for each leaf."""

    base: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray
    leaves: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1 for each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - inner]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 4, rate: float = 0.35, bins: int = 24, ridge: float = 1.0) -> BoostedTrees:
    """Newton boosting of the logistic loss; each level of a tree is grown from gradient histograms."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(width)]
    placed = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score, inner = np.full(n, base), 2**depth - 1
    features, thresholds, leaves = (np.zeros((trees, m)) for m in (inner, inner, inner + 1))
    features = features.astype(np.int64)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            own = at - first
            gain = np.full((count, width, bins), -np.inf)
            for k in range(width):
                key, size = own * bins + placed[:, k], count * bins
                g = np.bincount(key, grad, size).reshape(count, bins)
                h = np.bincount(key, hess, size).reshape(count, bins)
                gl, hl = np.cumsum(g, 1), np.cumsum(h, 1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain[:, k] = gl**2 / (hl + ridge) + gr**2 / (hr + ridge)
                gain[:, k, len(cuts[k]) :] = -np.inf
            best = gain.reshape(count, -1).argmax(1)
            for j in range(count):
                k, b = divmod(int(best[j]), bins)
                usable = np.isfinite(gain[j, k, b])
                features[t, first + j] = k
                thresholds[t, first + j] = cuts[k][b] if usable else np.inf
            f = features[t, at]
            at = 2 * at + 1 + (x[np.arange(n), f] > thresholds[t, at])
        own = at - inner
        g, h = np.bincount(own, grad, inner + 1), np.bincount(own, hess, inner + 1)
        leaves[t] = rate * g / (h + ridge)
        score += leaves[t, own]
    return BoostedTrees(base, features, thresholds, leaves)
