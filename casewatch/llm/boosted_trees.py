"""Histogram gradient-boosted trees, flattened into arrays for vectorised traversal.

Plain numpy: fitting takes a bounded sample of rows, scoring takes any batch. A fitted model is
five arrays of shape (trees, nodes), so a worker walks all rows of a batch one level at a time.
"""

from dataclasses import dataclass

import numpy as np

BINS = 128


@dataclass
class Forest:
    feature: np.ndarray  # (trees, nodes) int32
    threshold: np.ndarray  # (trees, nodes): go right where value > threshold; +inf in leaves
    value: np.ndarray  # (trees, nodes): leaf score
    depth: int
    start: float  # log odds before the first tree


def _bins(column, bins):
    """Cut points between distinct quantiles; fewer where values repeat."""
    points = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower") if len(column) else np.zeros(0)
    points = np.unique(points)
    return points[points < column.max()] if len(points) else points


def fit(x, y, trees=80, depth=4, rate=0.15, least=20, penalty=1.0, bins=BINS):
    """Logistic loss, second-order leaf values, one level of all nodes at a time.

    x: (rows, features) floats without nan; y: 0 or 1. One class only, or no rows, gives a constant.
    A node is split only if both sides get `least` rows and the gain is positive; ties take the
    first feature and cut, so the result does not depend on anything but the rows.
    """
    n, width = x.shape
    size = 2 ** (depth + 1) - 1
    rate_of_ones = (y.sum() + 0.5) / (n + 1.0)
    start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    shape = (trees, size)
    forest = Forest(np.zeros(shape, np.int32), np.full(shape, np.inf), np.zeros(shape), depth, start)
    if n == 0 or y.min() == y.max():
        return forest
    cuts = [_bins(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1).astype(np.int64)
    most = max(len(c) for c in cuts) + 1
    score = np.full(n, start)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            active = local >= 0
            best = np.full(count, 1e-9)
            chosen = np.full(count, -1)
            where = np.zeros(count, np.int64)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                at = local[active] * most + binned[active, f]
                g, h, c = (
                    np.bincount(at, w, count * most).reshape(count, most)
                    for w in (gradient[active], hessian[active], None)
                )
                gl, hl, cl = (np.cumsum(v, axis=1)[:, :-1] for v in (g, h, c))
                gt, ht, ct = (v.sum(axis=1, keepdims=True) for v in (g, h, c))
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                gain[(cl < least) | (ct - cl < least)] = 0
                gain[:, len(cuts[f]) :] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(count), cut]
                better = top > best
                best[better], chosen[better], where[better] = top[better], f, cut[better]
            for k in np.flatnonzero(chosen >= 0):
                forest.feature[tree, first + k] = chosen[k]
                forest.threshold[tree, first + k] = cuts[chosen[k]][where[k]]
            split = active & (chosen[np.where(active, local, 0)] >= 0)
            rows = np.flatnonzero(split)
            k = local[rows]
            right = binned[rows, chosen[k]] > where[k]
            stays = active & ~split
            node[rows] = 2 * node[rows] + 1 + right
            # a leaf above the last level sends its rows down its left children, as traversal does
            node[stays] = 2 * node[stays] + 1
        g, h = np.bincount(node, gradient, size), np.bincount(node, hessian, size)
        forest.value[tree] = rate * g / (h + penalty)
        score += forest.value[tree][node]
    return forest


def probability(forest, x):
    """Probability of class 1 for every row of x."""
    score = np.full(len(x), forest.start)
    rows = np.arange(len(x))
    for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(forest.depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        score += value[node]
    return 1 / (1 + np.exp(-score))
