"""Gradient-boosted decision trees for two classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    edges: list[np.ndarray]  # per feature: the upper edges of its bins
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray  # go right if the bin is above
    leaves: np.ndarray  # trees x leaves
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        depth = (self.leaves.shape[1] - 1).bit_length()
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (b[rows, features[node]] > cuts[node])
            out += leaves[node - (len(leaves) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray, trees: int = 80, depth: int = 5, step: float = 0.2, penalty: float = 1.0, n_bins: int = 32) -> Trees:
    """Boost logistic loss; each level of a tree takes the best cut of every node."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins)[1:-1])) for f in range(x.shape[1])]
    share = np.average(y, weights=weights)
    model = Trees(edges, np.zeros((trees, 2**depth - 1), np.int64), np.zeros((trees, 2**depth - 1), np.int64), np.zeros((trees, 2**depth)),
                  float(np.log(share / (1 - share))))
    b = model.bins(x)
    odds = np.full(len(x), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = weights * (p - y), weights * p * (1 - p)
        node = np.zeros(len(x), np.int64)  # number within the level
        for level in range(depth):
            n, first = 2**level, 2**level - 1
            best = np.full(n, 1e-6)
            features, cuts = np.zeros(n, np.int64), np.full(n, n_bins)
            for f in range(x.shape[1]):
                at = node * n_bins + b[:, f]
                gs = np.bincount(at, g, n * n_bins).reshape(n, n_bins).cumsum(axis=1)
                hs = np.bincount(at, h, n * n_bins).reshape(n, n_bins).cumsum(axis=1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (total_g - gs)**2 / (total_h - hs + penalty) - total_g**2 / (total_h + penalty)
                cut = gain.argmax(axis=1)
                better = gain[np.arange(n), cut] > best
                best = np.where(better, gain[np.arange(n), cut], best)
                features, cuts = np.where(better, f, features), np.where(better, cut, cuts)
            model.features[t, first:first + n], model.cuts[t, first:first + n] = features, cuts
            node = 2 * node + (b[np.arange(len(x)), features[node]] > cuts[node])
        leaf_g, leaf_h = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
        model.leaves[t] = -step * leaf_g / (leaf_h + penalty)
        odds += model.leaves[t][node]
    return model
