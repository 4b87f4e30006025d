"""Gradient-boosted trees for two classes, on histograms, in numpy alone."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of fixed depth, fitted to the logistic loss, with a threshold set on held-out rows.

    The same rows give the same trees. ``classes`` is 0 or 1 for each row.
    """

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.start = 0.0
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.threshold = 0.5

    def fit(self, features: np.ndarray, classes: np.ndarray, held_out: int = 4) -> Boosted:
        """Fit on all rows but every ``held_out``-th; those choose the threshold that gives the best F1."""
        x, y = np.asarray(features, np.float32), np.asarray(classes, np.float64)
        check = np.arange(len(y)) % held_out == held_out - 1
        self._grow(x[~check], y[~check])
        self._calibrate(self.predict(x[check]), y[check])
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray) -> None:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.start)
        width, size = x.shape[1], self.bins + 1
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                place = (at - first)[:, None] * (width * size) + np.arange(width) * size + binned
                g = np.bincount(place.ravel(), np.repeat(grad, width), count * width * size).reshape(count, width, size)
                h = np.bincount(place.ravel(), np.repeat(hess, width), count * width * size).reshape(count, width, size)
                gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
                ga, ha = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + self.least) + (ga - gl) ** 2 / (ha - hl + self.least) - ga**2 / (ha + self.least)
                gain[(hl < 1e-3) | (ha - hl < 1e-3)] = -1
                best = gain.reshape(count, -1).argmax(axis=1)
                for k in range(count):
                    j, b = divmod(int(best[k]), size)
                    if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                        feature[first + k], cut[first + k] = j, edges[j][b]
                at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
            leaf = at - (2**self.depth - 1)
            value = np.bincount(leaf, grad, 2**self.depth) / (np.bincount(leaf, hess, 2**self.depth) + self.least)
            self.nodes.append((feature, cut.astype(np.float32), (self.rate * value).astype(np.float32)))
            score += self.rate * value[leaf]

    def _calibrate(self, chance: np.ndarray, y: np.ndarray) -> None:
        best = -1.0
        for t in np.linspace(0.1, 0.9, 33):
            said = chance >= t
            right = float((said & (y > 0)).sum())
            f1 = 2 * right / max(1.0, said.sum() + y.sum())
            if f1 > best + 1e-9 or f1 > best - 1e-9 and abs(t - 0.5) < abs(self.threshold - 0.5):
                best, self.threshold = max(best, f1), float(t)

    def predict(self, features: np.ndarray) -> np.ndarray:
        """The chance of class 1 for each row."""
        x = np.asarray(features, np.float32)
        score = np.full(len(x), self.start, np.float32)
        rows = np.arange(len(x))
        for feature, cut, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            score += value[at - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-score))

    def holds(self, features: np.ndarray) -> np.ndarray:
        return self.predict(features) >= self.threshold if len(features) else np.zeros(0, bool)
