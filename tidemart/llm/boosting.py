"""Gradient-boosted trees for a bounded sample: logistic loss, fixed depth, thresholds at quantiles."""

from __future__ import annotations

import numpy as np

TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 24


class Boosted:
    """Trees as arrays: at node i of a level the row goes to 2 i + 1 if its feature is above the threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.trees: list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]] = []
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        codes = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)], axis=1)
        margin = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(codes, cuts, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(tree, x)

    @staticmethod
    def _grow(codes, cuts, gradient, hessian):
        node = np.zeros(len(codes), np.int64)
        features, thresholds = [], []
        for level in range(DEPTH):
            width = 1 << level
            best, feature, at = np.zeros(width), np.zeros(width, np.int64), np.zeros(width, np.int64)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell, bins = node * (len(c) + 1) + codes[:, f], width * (len(c) + 1)
                g, h = (np.bincount(cell, w, bins).reshape(width, -1) for w in (gradient, hessian))
                left_g, left_h = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = (left_g ** 2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1)
                        - all_g ** 2 / (all_h + 1))
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best[better], feature[better], at[better] = gain[np.arange(width), top][better], f, top[better]
            features.append(feature)
            thresholds.append(np.array([cuts[f][a] if len(cuts[f]) else np.inf
                                        for f, a in zip(feature, at, strict=True)]))
            node = 2 * node + (codes[np.arange(len(codes)), feature[node]] > at[node])
        g, h = (np.bincount(node, w, 1 << DEPTH) for w in (gradient, hessian))
        return features, thresholds, RATE * g / (h + 1)

    @staticmethod
    def _leaf(tree, x: np.ndarray) -> np.ndarray:
        features, thresholds, values = tree
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for feature, threshold in zip(features, thresholds, strict=True):
            node = 2 * node + (x[rows, feature[node]] > threshold[node])
        return values[node]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        for tree in self.trees:
            margin += self._leaf(tree, x)
        return 1 / (1 + np.exp(-margin))
