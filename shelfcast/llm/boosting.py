"""Gradient-boosted trees for two classes in numpy: histograms, level by level, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Full binary trees of one depth: split feature and threshold of each inner node, value of each leaf."""

    features: np.ndarray  # (trees, 2^depth - 1)
    thresholds: np.ndarray
    leaves: np.ndarray  # (trees, 2^depth)
    base: float

    def parts(self) -> tuple:
        return self.features, self.thresholds, self.leaves, self.base

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are at one depth
                node = 2 * node + 1 + (x[rows, features[node]] > thresholds[node])
            out += leaves[node - inner]
        return out


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 5,
    rate: float = 0.2,
    bins: int = 32,
    column_share: float = 0.4,
    least: float = 1.0,
    decay: float = 1.0,
    seed: int = 0,
) -> Trees:
    """Newton boosting. Columns are cut into bins at quantiles; each tree sees a share of the columns; a split needs
    `least` of hessian on both sides, and leaves shrink by `decay`."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    edges, codes = [], np.empty((width, n), np.uint8)
    for f in range(width):
        cut = np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
        if len(cut) < bins - 1:  # few distinct values: cut between them
            values = np.unique(x[:, f])
            if len(values) <= bins:
                cut = (values[1:] + values[:-1]) / 2
        edges.append(cut)
        codes[f] = np.searchsorted(cut, x[:, f], side="left")
    useful = np.array([f for f in range(width) if len(edges[f])])
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner = (1 << depth) - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    for t in range(trees if len(useful) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        columns = rng.choice(useful, max(1, int(len(useful) * column_share)), replace=False)
        node = np.zeros(n, np.int64)  # place within the level
        for level in range(depth):
            width_ = 1 << level
            total_g, total_h = np.bincount(node, g, width_), np.bincount(node, h, width_)
            best = np.full(width_, 1e-6)
            split = np.zeros(width_, np.int64)
            at = np.full(width_, np.inf)
            code_at = np.full(width_, bins, np.int64)
            for f in columns:
                cell = node * bins + codes[f]
                hist_g = np.bincount(cell, g, width_ * bins).reshape(width_, bins).cumsum(axis=1)[:, : len(edges[f])]
                hist_h = np.bincount(cell, h, width_ * bins).reshape(width_, bins).cumsum(axis=1)[:, : len(edges[f])]
                right_g, right_h = total_g[:, None] - hist_g, total_h[:, None] - hist_h
                gain = hist_g**2 / (hist_h + decay) + right_g**2 / (right_h + decay) - (total_g**2 / (total_h + decay))[:, None]
                gain[(hist_h < least) | (right_h < least)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(width_), k]
                better = top > best
                best[better], split[better], code_at[better] = top[better], f, k[better]
                at[better] = edges[f][k[better]]
            first = (1 << level) - 1
            out.features[t, first : first + width_], out.thresholds[t, first : first + width_] = split, at
            node = 2 * node + (codes[split[node], np.arange(n)] > code_at[node])
        sum_g, sum_h = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        out.leaves[t] = -rate * sum_g / (sum_h + decay)
        margin += out.leaves[t][node]
    return out
