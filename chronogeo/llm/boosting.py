"""Histogram gradient-boosted trees for a yes/no label, kept as flat arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    """Complete binary trees by level: node i has the children 2i+1 and 2i+2. A node that doesn't split sends all left."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); larger values go right
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def constant(share: float) -> Trees:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return Trees(float(np.log(share / (1 - share))), np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smooth: float = 1.0, least: int = 10) -> Trees:
    """Trees for features x and labels y (0 or 1). Without rows the score is 0.5, with one label only it is near that label."""
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    base = constant(float(y.mean())).base
    score, inner = np.full(n, base), 2 ** depth - 1
    out_f, out_t, out_l = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(depth):
            first, k = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.full(k, 1e-6)
            cut = np.full(k, -1)
            for f in range(width):
                key = local * bins + binned[:, f]
                gs, hs, ns = (np.cumsum(np.bincount(key, w, k * bins).reshape(k, bins), 1) for w in (g, h, None))
                gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                gain = gs ** 2 / (hs + smooth) + (gt - gs) ** 2 / (ht - hs + smooth) - gt ** 2 / (ht + smooth)
                gain[(ns < least) | (nt - ns < least)] = 0
                gain[:, len(edges[f]):] = 0
                at = gain.argmax(1)
                better = gain[np.arange(k), at] > best
                best[better], cut[better] = gain[np.arange(k), at][better], at[better]
                feature[first:first + k][better] = f
            for i in np.flatnonzero(cut >= 0):
                threshold[first + i] = edges[feature[first + i]][cut[i]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        where = node - inner
        leaf = -rate * np.bincount(where, g, inner + 1) / (np.bincount(where, h, inner + 1) + smooth)
        score += leaf[where]
        out_f.append(feature), out_t.append(threshold), out_l.append(leaf)
    return Trees(base, np.array(out_f), np.array(out_t), np.array(out_l))
