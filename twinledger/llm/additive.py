"""Generalised additive model with pairwise interactions, trained by cyclic boosting.

Every feature has a lookup table over its bins, every chosen pair a small grid. Training visits
them in turn and adds a shallow tree, fitted to the current residuals on the bin histogram, to the
table. A score is the sum of one table entry per feature and pair, so scoring is bin lookups only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np


@dataclass
class AdditiveModel:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label 1 for every row."""
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        if self.pairs:
            coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], "right")
                      for f in {f for pair in self.pairs for f in pair}}
            for (a, b), grid in zip(self.pairs, self.grids):
                total += grid[coarse[a], coarse[b]]
        return _sigmoid(total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins: quantiles, halfway to the next value that occurs."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return np.zeros(0)
    middles = (distinct[1:] + distinct[:-1]) / 2
    if len(middles) < bins:
        return middles
    cuts = np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])
    return np.unique(middles[np.clip(np.searchsorted(distinct, cuts, "right") - 1, 0, len(middles) - 1)])


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Leaf value for each bin of the best tree of some depth over ordered bins."""
    n = len(g)
    if depth and n > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        all_g, all_h = g.sum(), h.sum()
        gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > all_g**2 / (all_h + ridge) + 1e-9:
            return np.concatenate([_tree(g[:cut], h[:cut], depth - 1, ridge),
                                   _tree(g[cut:], h[cut:], depth - 1, ridge)])
    return np.full(n, g.sum() / (h.sum() + ridge))


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts a grid once on each axis."""
    sums = [np.zeros((m.shape[0] + 1, m.shape[1] + 1)) for m in (g, h)]
    for s, m in zip(sums, (g, h)):
        s[1:, 1:] = m.cumsum(0).cumsum(1)
    parts = []
    for s in sums:
        low = s[1:-1, 1:-1]
        top, left, total = s[1:-1, -1:], s[-1:, 1:-1], s[-1, -1]
        parts.append((low, top - low, left - low, total - top - left + low))
    gain = sum(pg**2 / (ph + ridge) for pg, ph in zip(*parts))
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [pg[i, j] / (ph[i, j] + ridge) for pg, ph in zip(*parts)]
    leaf = np.empty_like(g)
    leaf[:i + 1, :j + 1], leaf[:i + 1, j + 1:], leaf[i + 1:, :j + 1], leaf[i + 1:, j + 1:] = values
    alone = sums[0][-1, -1] ** 2 / (sums[1][-1, -1] + ridge)
    return float(gain[i, j] - alone), leaf


def train(x: np.ndarray, y: np.ndarray, *, bins: int = 48, depth: int = 2, rounds: int = 120,
          rate: float = 0.15, pair_bins: int = 8, n_pairs: int = 8, pair_rounds: int = 60,
          ridge: float = 2.0) -> AdditiveModel:
    """Fit on a feature matrix and labels 0/1. One label only gives a constant model."""
    y = np.asarray(y, np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(float(np.log(share / (1 - share))), [_edges(c, bins) for c in x.T], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(y) == 0 or y.min() == y.max():
        return model
    binned = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T)]
    total = np.full(len(y), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(total)
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for table, at in zip(model.tables, binned):
            if len(table) > 1:
                g, h = residuals()
                step = rate * _tree(np.bincount(at, g, len(table)), np.bincount(at, h, len(table)), depth, ridge)
                table += step
                total += step[at]

    model.pair_edges = [_edges(c, pair_bins) for c in x.T]
    coarse = [np.searchsorted(e, c, "right") for e, c in zip(model.pair_edges, x.T)]
    size = [len(e) + 1 for e in model.pair_edges]

    def grid_sums(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, shape = coarse[a] * size[b] + coarse[b], (size[a], size[b])
        return tuple(np.bincount(at, v, size[a] * size[b]).reshape(shape) for v in (g, h))

    g, h = residuals()
    gains = {p: _quadrants(*grid_sums(*p, g, h), ridge)[0]
             for p in combinations(range(x.shape[1]), 2) if size[p[0]] > 1 and size[p[1]] > 1}
    model.pairs = sorted(sorted(gains, key=gains.get, reverse=True)[:n_pairs])
    model.grids = [np.zeros((size[a], size[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), grid in zip(model.pairs, model.grids):
            g, h = residuals()
            step = rate * _quadrants(*grid_sums(a, b, g, h), ridge)[1]
            grid += step
            total += step[coarse[a], coarse[b]]
    return model
