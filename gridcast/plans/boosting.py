"""Gradient-boosted regression trees on one bounded window, with an L2 leaf penalty.

Squared error, second-order gains ``GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)``, a split stays if
its gain reaches γ and both sides have ``min_child`` rows. Features are binned once at
quantiles of the training rows; each round takes a sample of rows and of columns. The
library calls it per (series, fold), so that folds and series are the parallel tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosting:
    """Hyper-parameters; the defaults are fixed values that must match the reference's."""

    rounds: int = 500
    depth: int = 3
    rate: float = 0.03
    rows: float = 0.7
    columns: float = 0.7
    min_child: float = 20.0
    l2: float = 5.0
    gamma: float = 1.0
    bins: int = 256
    seed: int = 42


class BoostedTrees:
    """A fitted ensemble: complete trees of ``depth`` levels; a node without a split sends all rows left."""

    def __init__(self, edges: list[np.ndarray], base: float, depth: int):
        self.edges, self.base, self.depth = edges, base, depth
        self.features, self.cuts, self.leaves = [], [], []
        self.gain, self.splits = np.zeros(len(edges)), np.zeros(len(edges))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def leaf_of(self, binned: np.ndarray, t: int) -> np.ndarray:
        at, row = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[row, self.features[t][at]] > self.cuts[t][at])
        return at - (2 ** self.depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned, out = self.binned(x), np.full(len(x), self.base)
        for t in range(len(self.leaves)):
            out += self.leaves[t][self.leaf_of(binned, t)]
        return out

    def importance(self) -> np.ndarray:
        """Mean gain of a feature's splits, normed to 1."""
        mean = self.gain / np.maximum(self.splits, 1)
        return mean / max(mean.sum(), 1e-300)


def fit_boosted(x: np.ndarray, y: np.ndarray, p: Boosting = Boosting()) -> tuple[BoostedTrees, np.ndarray]:
    """The ensemble of a window and its predictions on the window's own rows."""
    n, k = x.shape
    inner = np.linspace(0, 1, p.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], inner, method="lower")) for j in range(k)]
    model = BoostedTrees(edges, float(y.mean()), p.depth)
    binned = model.binned(x)
    random = np.random.default_rng(p.seed)
    fitted = np.full(n, model.base)
    width, taken = p.bins, max(1, int(p.columns * k))
    by_feature = np.ascontiguousarray(binned.T)
    for _ in range(p.rounds):
        gradient = fitted - y
        rows = np.flatnonzero(random.random(n) < p.rows)
        cols = np.sort(random.permutation(k)[:taken])
        cells = [by_feature[j].take(rows) for j in cols]  # a feature at a time: its bins stay in the cache
        g = gradient[rows]
        nodes = 2 ** (p.depth + 1) - 1
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, width, np.int64)
        at = np.zeros(len(rows), np.int64)  # node within the level
        for level in range(p.depth):
            parents = 2 ** max(level - 1, 0)
            left_g, left_h = np.empty((parents, taken, width)), np.empty((parents, taken, width), np.int64)
            left = None if level == 0 else np.flatnonzero(at % 2 == 0)  # the right children are what is left
            own, base = (g, None) if level == 0 else (g[left], at[left] // 2 * width)
            for i, cell in enumerate(cells):
                place = cell if level == 0 else cell.take(left) + base
                left_g[:, i] = np.bincount(place, own, parents * width).reshape(parents, width)
                left_h[:, i] = np.bincount(place, minlength=parents * width).reshape(parents, width)
            if level == 0:
                hist_g, hist_h = left_g, left_h
            else:
                hist_g = np.stack([left_g, hist_g - left_g], 1).reshape(2 * parents, taken, width)
                hist_h = np.stack([left_h, hist_h - left_h], 1).reshape(2 * parents, taken, width)
            gl, hl = hist_g.cumsum(2), hist_h.cumsum(2).astype(float)
            total_g, total_h = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = total_g - gl, total_h - hl
            gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - total_g ** 2 / (total_h + p.l2)
            gain[(hl < p.min_child) | (hr < p.min_child)] = -np.inf
            flat = gain.reshape(2 ** level, -1)
            best = flat.argmax(1)
            for i in range(2 ** level):
                won = flat[i, best[i]]
                if won >= p.gamma and won > 1e-6:
                    j = cols[best[i] // width]
                    node = 2 ** level - 1 + i
                    feature[node], cut[node] = j, best[i] % width
                    model.gain[j] += won
                    model.splits[j] += 1
            node = 2 ** level - 1 + at
            at = 2 * at + (by_feature[feature[node], rows] > cut[node])
        sums = np.bincount(at, g, 2 ** p.depth)
        counts = np.bincount(at, minlength=2 ** p.depth)
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(-p.rate * sums / (counts + p.l2))
        fitted += model.leaves[-1][model.leaf_of(binned, len(model.leaves) - 1)]
    return model, fitted
