"""Gradient-boosted decision trees for a binary target (numpy, histograms of binned features)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 16


@dataclass
class BoostedTrees:
    edges: list[np.ndarray]
    prior: float
    depth: int
    #: per tree: feature and bin of every inner node (heap order), value of every leaf
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        z = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            z += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.25, ridge: float = 1.0) -> BoostedTrees:
    """Trees of equal depth, grown level by level; a node that gains nothing sends everything left."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = BoostedTrees(edges, float(np.log(p / (1 - p))), depth, [])
    b = model.binned(x).astype(np.int64)
    n_features, every = x.shape[1], np.arange(len(y))
    # most features are nearly always in one bin, which gets what the other bins leave of a node's sum
    usual = np.array([np.bincount(b[:, j], minlength=BINS).argmax() for j in range(n_features)], np.int64)
    row, column = np.nonzero(b != usual)
    cell = column * BINS + b[row, column]

    def sums(slot: np.ndarray, n: int, weight: np.ndarray) -> np.ndarray:
        """(node, feature, bin): the weight up to and with each bin."""
        bins = np.bincount(slot[row] * (n_features * BINS) + cell, weight[row], n * n_features * BINS).reshape(n, n_features, BINS)
        bins[:, np.arange(n_features), usual] = np.bincount(slot, weight, n)[:, None] - bins.sum(2)
        return bins.cumsum(2)

    z = np.full(len(y), model.prior)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-z))
        g, h = q - y, q * (1 - q)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, 255, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            lo, n = 2**level - 1, 2**level
            slot = node - lo
            gs, hs = sums(slot, n, g), sums(slot, n, h)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = (gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge))[:, :, :-1].reshape(n, -1)
            at = gain.argmax(1)
            better = gain[np.arange(n), at] > 1e-6
            feature[lo : lo + n][better], cut[lo : lo + n][better] = at[better] // (BINS - 1), at[better] % (BINS - 1)
            node = 2 * node + 1 + (b[every, feature[node]] > cut[node])
        slot = node - (2**depth - 1)
        leaf = -rate * np.bincount(slot, g, 2**depth) / (np.bincount(slot, h, 2**depth) + ridge)
        z += leaf[slot]
        model.trees.append((feature, cut, leaf))
    return model
