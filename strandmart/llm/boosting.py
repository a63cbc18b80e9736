"""Gradient-boosted trees for two classes, on binned features, small enough to fit on the driver and ship to tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees level by level: feature, threshold (go right above it), and value of each leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the positive class."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 5.0) -> Trees:
    """Second-order boosting on the logistic loss; splits come from histograms over quantile bins."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    n, width = x.shape
    cells = (binned + np.arange(width) * bins).astype(np.int64)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, 2**depth))
    for t in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, curve = y - chance, chance * (1 - chance)
        at = np.zeros(n, np.int64)
        for node in range(inner):
            mine = np.flatnonzero(at == node)
            if len(mine) >= 20:
                flat = cells[mine].ravel()
                g = np.bincount(flat, np.repeat(slope[mine], width), width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(flat, np.repeat(curve[mine], width), width * bins).reshape(width, bins).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                best = int(gain.argmax())
                f, b = divmod(best, bins)
                if gain[f, b] > 1e-6 and b < len(edges[f]):
                    feature[t, node], threshold[t, node] = f, edges[f][b]
            at[mine] = 2 * node + 1 + (x[mine, feature[t, node]] > threshold[t, node])
        place = at - inner
        g, h = np.bincount(place, slope, 2**depth), np.bincount(place, curve, 2**depth)
        leaf[t] = rate * g / (h + ridge)
        score += leaf[t][place]
    return Trees(feature, threshold, leaf, start)
