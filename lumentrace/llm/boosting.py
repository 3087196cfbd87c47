"""Gradient-boosted trees over binned dense features and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np


class Trees:
    """Second-order boosting of the logistic loss with depth-limited trees over quantile bins."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 1.0, least_weight: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least_weight
        self.cuts: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1) if len(x) else np.zeros(x.shape, np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b, n_bins = self._binned(x), self.bins + 1
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-raw))
            g, h = y - q, np.maximum(q * (1 - q), 1e-6)
            nodes = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)
            node = np.zeros(len(y), np.int64)
            value[0] = g.sum() / (h.sum() + self.l2)
            for level in range(self.depth):
                first = 2**level - 1
                for k in range(first, first + 2**level):
                    own = node == k
                    if not own.any():
                        continue
                    best = self._split(b[own], g[own], h[own], n_bins)
                    if best is None:
                        continue
                    feature[k], cut[k] = best
                    right = b[:, best[0]] > best[1]
                    node[own & ~right], node[own & right] = 2 * k + 1, 2 * k + 2
                    for child in (2 * k + 1, 2 * k + 2):
                        at = node == child
                        value[child] = g[at].sum() / (h[at].sum() + self.l2)
            raw += self.rate * value[node]
            self.trees.append((feature, cut, value))
        return self

    def _split(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, n_bins: int) -> tuple[int, int] | None:
        total_g, total_h = g.sum(), h.sum()
        best, found = 1e-3, None
        for j in range(b.shape[1]):
            left_g = np.bincount(b[:, j], g, n_bins).cumsum()[:-1]
            left_h = np.bincount(b[:, j], h, n_bins).cumsum()[:-1]
            gain = left_g**2 / (left_h + self.l2) + (total_g - left_g) ** 2 / (total_h - left_h + self.l2) - total_g**2 / (total_h + self.l2)
            gain[(left_h < self.least) | (total_h - left_h < self.least)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = float(gain[k]), (j, k)
        return found

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = b[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += self.rate * value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y on x by pooling adjacent violators; equal x are pooled first."""
    at, inverse = np.unique(x, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    level = np.bincount(inverse, y) / weight
    blocks: list[list[float]] = []  # level, weight, first, last
    for i in range(len(at)):
        blocks.append([level[i], weight[i], at[i], at[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, _, last = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + v * w) / (b[1] + w), b[1] + w, last
    xs = np.array([z for b in blocks for z in ((b[2], b[3]) if b[3] > b[2] else (b[2],))])
    ys = np.array([b[0] for b in blocks for _ in range(2 if b[3] > b[2] else 1)])
    return xs, ys
