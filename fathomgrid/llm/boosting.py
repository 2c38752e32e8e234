"""Gradient-boosted trees for several classes on small whole-number features, in numpy."""

from __future__ import annotations

import numpy as np


class Trees:
    """Softmax boosting: per round and class one tree of fixed depth over thresholds x > t."""

    def __init__(self, rounds: int = 16, depth: int = 4, rate: float = 0.4, least: int = 3, smooth: float = 1.0):
        self.rounds, self.depth, self.rate, self.least, self.smooth = rounds, depth, rate, least, smooth
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        self.classes = 0

    def fit(self, x: np.ndarray, y: np.ndarray, classes: int) -> Trees:
        """x: (n, features) of small non-negative integers; y: class numbers. Equal rows count once, with their weight."""
        both, weight = np.unique(np.column_stack([x.astype(np.int64), y]), axis=0, return_counts=True)
        x, y = both[:, :-1], both[:, -1]
        self.classes, n = classes, len(x)
        onehot = np.eye(classes)[y]
        score = np.zeros((n, classes))
        top = int(x.max()) + 1
        flat = (x.astype(np.int64) + np.arange(x.shape[1]) * top).ravel()
        for _ in range(self.rounds):
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            layer = []
            for c in range(classes):
                g, h = weight * (onehot[:, c] - p[:, c]), weight * np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
                tree = self._tree(x, flat, top, g, h)
                layer.append(tree)
                score[:, c] += self._walk(tree, x)
            self.trees.append(layer)
        return self

    def _tree(self, x: np.ndarray, flat: np.ndarray, top: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A complete binary tree: feature and threshold of inner nodes, value of leaves."""
        n, m = x.shape
        inner = (1 << self.depth) - 1
        feature, limit = np.zeros(inner, np.int64), np.full(inner, top, np.int64)
        where = np.zeros(n, np.int64)
        for node in range(inner):
            rows = np.flatnonzero(where == node)
            if len(rows) >= 2 * self.least:
                f = flat.reshape(n, m)[rows].ravel()
                gs, hs = (np.bincount(f, np.repeat(v[rows], m), m * top).reshape(m, top) for v in (g, h))
                ns = np.bincount(f, minlength=m * top).reshape(m, top)
                gl, hl, nl = gs.cumsum(1), hs.cumsum(1), ns.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + self.smooth) + (gt - gl) ** 2 / (ht - hl + self.smooth) - gt**2 / (ht + self.smooth)
                gain[(nl < self.least) | (len(rows) - nl < self.least)] = -1
                k = int(gain.argmax())
                if gain.flat[k] > 1e-9:
                    feature[node], limit[node] = k // top, k % top
            where = np.where(where == node, 2 * node + 1 + (x[:, feature[node]] > limit[node]), where)
        leaf = where - inner
        size = 1 << self.depth
        value = self.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.smooth)
        return feature, limit, value

    def _walk(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
        feature, limit, value = tree
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
        return value[at - len(feature)]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        score = np.zeros((len(x), self.classes))
        for layer in self.trees:
            for c, tree in enumerate(layer):
                score[:, c] += self._walk(tree, x)
        score -= score.max(1, keepdims=True)
        return score - np.log(np.exp(score).sum(1, keepdims=True))
