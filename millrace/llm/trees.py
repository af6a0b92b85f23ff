"""Gradient-boosted trees for a two-class answer, on a bounded table that fits one process."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete binary trees: per tree the feature and threshold of each inner node and the value of each leaf."""

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - len(f)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss over histogram splits."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    score = np.full(len(y), start)
    inner = (1 << depth) - 1
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            node = at - first
            best = np.zeros(width)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = node * (len(c) + 1) + binned[:, f]
                gs, hs = (np.bincount(cell, w, width * (len(c) + 1)).reshape(width, -1).cumsum(1) for w in (g, h))
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - total_g**2 / (total_h + ridge)
                split = gain[:, :-1].argmax(1)
                better = gain[np.arange(width), split] > best + 1e-9
                best = np.where(better, gain[np.arange(width), split], best)
                feature[first : first + width][better] = f
                threshold[first : first + width][better] = c[split[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        score = score + value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Boosted(depth, np.array(features), np.array(thresholds), np.array(values), start)
