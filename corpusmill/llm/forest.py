"""A small random forest: fitted from a bounded table of labelled rows, applied as a column expression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[int, float] | None:
    """The feature and threshold with the least Gini impurity; None if none helps."""
    best, found = len(y) * _gini(y.mean()) - 1e-9, None
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        left = np.cumsum(t)[cut]
        n = cut + 1.0
        m = len(y) - n
        cost = n * _gini(left / n) + m * _gini((t.sum() - left) / m)
        k = int(cost.argmin())
        if cost[k] < best:
            best, found = cost[k], (int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return found


def _gini(p):
    return 2 * p * (1 - p)


def _grow(x: np.ndarray, y: np.ndarray, depth: int, least: int, rng: np.random.Generator):
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    at = _split(x, y, rng.permutation(x.shape[1])[: max(1, round(x.shape[1] ** 0.5))])
    if at is None:
        return float(y.mean())
    right = x[:, at[0]] > at[1]
    if min(right.sum(), (~right).sum()) < least:
        return float(y.mean())
    return (*at, _grow(x[~right], y[~right], depth - 1, least, rng), _grow(x[right], y[right], depth - 1, least, rng))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 5, least: int = 5, seed: int = 5) -> list:
    """Trees: a leaf is a share of positives, an inner node (feature, threshold, left, right)."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        out.append(_grow(x[rows], y[rows], depth, least, rng))
    return out


def predict(trees: list, row) -> float:
    """The forest's mean for one row of features."""
    total = 0.0
    for t in trees:
        while isinstance(t, tuple):
            t = t[3] if row[t[0]] > t[1] else t[2]
        total += t
    return total / len(trees)


def expression(trees: list, features: list[Column]) -> Column:
    """The same mean as a column."""

    def node(t) -> Column:
        if not isinstance(t, tuple):
            return F.lit(t)
        return F.when(features[t[0]] > F.lit(t[1]), node(t[3])).otherwise(node(t[2]))

    total = node(trees[0])
    for t in trees[1:]:
        total = total + node(t)
    return total / F.lit(float(len(trees)))
