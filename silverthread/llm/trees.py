"""Gradient-boosted trees: trained on binned features, scored from flat arrays.

A forest is a set of numpy arrays, one row per tree and one column per node, so a
batch of rows descends all trees level by level without a loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of one depth. Node n has the children 2n+1 and 2n+2."""

    feature: np.ndarray  # trees x inner nodes; -1 where a node was not split
    threshold: np.ndarray  # trees x inner nodes; values above it go right
    leaf: np.ndarray  # trees x leaves
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                right = (x[rows, f] > threshold[node]) & (f >= 0)
                node = 2 * node + 1 + right
            total += leaf[node - len(feature)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def constant(probability: float, depth: int = 1) -> Forest:
    """A forest that gives every row the same score."""
    p = min(max(probability, 1e-6), 1 - 1e-6)
    inner = 2**depth - 1
    return Forest(
        np.full((1, inner), -1), np.zeros((1, inner)), np.zeros((1, inner + 1)),
        float(np.log(p / (1 - p))), depth,
    )


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    l2: float = 1.0,
    min_hessian: float = 3.0,
) -> Forest:
    """Fit to labels 0 and 1 by second-order boosting on logistic loss.

    ``monotone`` has +1, -1 or 0 per feature: the score never falls, never rises, or
    is free as that feature grows. A split that would break the order of its two
    sides is not taken, and the values below each side are bounded by the middle of
    the two, so the order holds between whole subtrees. Ties go to the first feature
    and the lowest bin. One class or no rows give a constant.
    """
    n = len(y)
    if n == 0 or y.min() == y.max():
        return constant(float(y.mean()) if n else 0.5)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    features = np.full((trees, inner), -1)
    thresholds = np.zeros((trees, inner))
    values = np.zeros((trees, leaves))
    for t in range(trees):
        prob = 1.0 / (1.0 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        low, high = np.full(2 * leaves, -np.inf), np.full(2 * leaves, np.inf)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            left, right = 2 * k + 1, 2 * k + 2
            low[[left, right]], high[[left, right]] = low[k], high[k]
            node[here] = left
            best = _best_split(binned, edges, here, g, h, monotone, low[k], high[k], l2, min_hessian)
            if best is None:
                continue
            f, b, w_left, w_right = best
            features[t, k], thresholds[t, k] = f, edges[f][b]
            node[here] = left + (binned[here, f] > b)
            if monotone[f]:
                middle = (w_left + w_right) / 2
                up, down = (right, left) if monotone[f] > 0 else (left, right)
                low[up], high[down] = max(low[k], middle), min(high[k], middle)
        at = node - inner
        sum_g, sum_h = np.bincount(at, g, leaves), np.bincount(at, h, leaves)
        w = np.clip(-sum_g / (sum_h + l2), low[inner : inner + leaves], high[inner : inner + leaves])
        values[t] = rate * w
        margin += values[t][at]
    return Forest(features, thresholds, values, base, depth)


def _best_split(binned, edges, here, g, h, monotone, low, high, l2, min_hessian):
    """(feature, bin, left value, right value) of the largest gain, or None."""
    best, best_gain = None, 1e-6
    if len(here) < 2:
        return None
    total_g, total_h = g[here].sum(), h[here].sum()
    for f, e in enumerate(edges):
        if not len(e):
            continue
        b = binned[here, f]
        left_g = np.cumsum(np.bincount(b, g[here], len(e) + 1))[:-1]
        left_h = np.cumsum(np.bincount(b, h[here], len(e) + 1))[:-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        w_left = np.clip(-left_g / (left_h + l2), low, high)
        w_right = np.clip(-right_g / (right_h + l2), low, high)
        gain = _gain(left_g, left_h, w_left, l2) + _gain(right_g, right_h, w_right, l2)
        w = np.clip(-total_g / (total_h + l2), low, high)
        gain = gain - _gain(total_g, total_h, w, l2)
        fine = (left_h >= min_hessian) & (right_h >= min_hessian)
        fine &= (w_right - w_left) * monotone[f] >= 0
        gain = np.where(fine, gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > best_gain:
            best, best_gain = (f, k, w_left[k], w_right[k]), gain[k]
    return best


def _gain(g, h, w, l2):
    return -(g * w + 0.5 * (h + l2) * w * w)
