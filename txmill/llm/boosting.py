"""Histogram gradient-boosted trees for a yes/no label, and their traversal with numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64
TREES = 80
DEPTH = 4
LEARNING_RATE = 0.12
L2 = 1.0
LEAST_WEIGHT = 3.0


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth, flattened: node i has the children 2i+1 and 2i+2.

    ``feature`` and ``threshold`` are (trees, inner nodes), ``leaf`` is (trees, leaves). A row goes
    right if its feature is above the threshold; a node without a split has an infinite one.
    """

    bias: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees at once."""
        total = np.full(len(rows), self.bias)
        trees = np.arange(len(self.leaf))
        inner = self.feature.shape[1]
        depth = int(np.log2(inner + 1))
        for start in range(0, len(rows), 2048):
            part = rows[start : start + 2048]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(depth):
                above = part[row, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + above
            total[start : start + 2048] += self.leaf[trees, node - inner].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-total))


def constant(probability: float) -> Forest:
    """The same score for every row."""
    odds = np.log(probability / (1.0 - probability))
    return Forest(float(odds), np.zeros((1, 1), np.int64), np.full((1, 1), np.inf), np.zeros((1, 2)))


def fit(
    rows: np.ndarray,
    label: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = LEARNING_RATE,
    bins: int = BINS,
) -> Forest:
    """Boost the log loss. Features are cut at quantiles once; every level sums its histograms.

    Without rows the score is 0.5; with one class only it is near that class.
    """
    if not len(rows):
        return constant(0.5)
    mean = (label.sum() + 1.0) / (len(label) + 2.0)
    if label.min() == label.max():
        return constant(mean)
    width = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.arange(1, bins) / bins)) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f]) for f in range(width)])
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    bias = float(np.log(mean / (1.0 - mean)))
    total = np.full(len(rows), bias)
    everyone = np.arange(len(rows))
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        gradient, weight = label - p, p * (1.0 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = (node - first) * bins
            cells = [slot + binned[f] for f in range(width)]
            sums = [
                np.stack([np.bincount(c, v, count * bins) for c in cells]).reshape(width, count, bins)
                for v in (gradient, weight)
            ]
            g, h = (s.cumsum(axis=2) for s in sums)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = (
                g**2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g**2 / (all_h + L2)
            )
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = -np.inf
            best = gain.transpose(1, 0, 2).reshape(count, -1)
            at = best.argmax(axis=1)
            for n in range(count):
                f, b = divmod(int(at[n]), bins)
                if best[n, at[n]] > 1e-9 and b < len(cuts[f]):
                    feature[t, first + n], threshold[t, first + n] = f, cuts[f][b]
            above = rows[everyone, feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + above
        g = np.bincount(node - inner, gradient, inner + 1)
        h = np.bincount(node - inner, weight, inner + 1)
        leaf[t] = rate * g / (h + L2)
        total += leaf[t][node - inner]
    return Forest(bias, feature, threshold, leaf)
