"""Isolation forest: rows that random splits separate early are anomalous."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    out = np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, 0.0)
    return np.where(n == 2, 1.0, out)


@dataclass
class IsolationForest:
    """Trees as arrays: a full binary tree of ``depth`` levels, node i has children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x nodes, -1 at a leaf
    cut: np.ndarray
    length: np.ndarray  # path length that ends at the node
    sample: int
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies, below 0.5 for usual rows."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                deeper = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= cut[node])
                node = np.where(f >= 0, deeper, node)
            total += length[node]
        return 2.0 ** (-total / (len(self.feature) * max(float(expected_path(self.sample)), 1e-9)))


def grow(x: np.ndarray, *, trees: int = 100, sample: int = 256, seed: int = 7) -> IsolationForest:
    """Each tree takes ``sample`` rows and splits a random feature at a random value between its
    extremes, until rows stand alone or the depth of a balanced tree is reached."""
    rng = np.random.default_rng(seed)
    sample = min(sample, max(len(x), 1))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int64)
    cut, length = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        rows = rng.choice(len(x), sample, replace=False) if len(x) else np.zeros(0, np.int64)
        stack = [(0, 0, rows)]
        while stack:
            node, level, held = stack.pop()
            length[t, node] = level + float(expected_path(len(held)))
            if level == depth or len(held) < 2:
                continue
            low, high = x[held].min(0), x[held].max(0)
            open_features = np.flatnonzero(high > low)
            if not len(open_features):
                continue
            f = int(rng.choice(open_features))
            at = rng.uniform(low[f], high[f])
            feature[t, node], cut[t, node] = f, at
            right = x[held, f] >= at
            stack += [(2 * node + 1, level + 1, held[~right]), (2 * node + 2, level + 1, held[right])]
    return IsolationForest(feature, cut, length, sample, depth)
