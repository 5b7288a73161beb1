"""Gradient-boosted trees for two classes, on binned features; small enough to train on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 60
LEVELS = 4
RATE = 0.25
BINS = 32
RIDGE = 1.0


@dataclass
class Trees:
    """Complete trees of one depth as arrays: splits (feature, threshold) level by level, then leaves."""
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of ``x``."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - inner] if len(at) else 0.0
        return total


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss with histogram splits; ties go to the first feature and bin."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)])
    share = np.average(y, weights=weight)
    base = float(np.log(share / (1 - share)))
    raw, inner = np.full(len(y), base), 2 ** LEVELS - 1
    features, thresholds, leaves = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = 1e-6
            total_g, total_h = g[rows].sum(), h[rows].sum()
            cut = None
            if len(rows) > 20:
                for k, edge in enumerate(edges):
                    if not len(edge):
                        continue
                    b = binned[rows, k]
                    left_g = np.bincount(b, weights=g[rows], minlength=len(edge) + 1).cumsum()[:-1]
                    left_h = np.bincount(b, weights=h[rows], minlength=len(edge) + 1).cumsum()[:-1]
                    right_g, right_h = total_g - left_g, total_h - left_h
                    gain = left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - total_g ** 2 / (total_h + RIDGE)
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, cut = gain[i], (k, i)
            if cut:
                feature[node], threshold[node] = cut[0], edges[cut[0]][cut[1]]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        leaf = np.zeros(inner + 1)
        place = at - inner
        sums_g, sums_h = (np.bincount(place, weights=v, minlength=inner + 1) for v in (g, h))
        leaf = RATE * sums_g / (sums_h + RIDGE)
        raw += leaf[place]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), base)
