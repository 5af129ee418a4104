"""Boosted trees for yes-or-no answers: trained in numpy, applied as one SQL expression."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 30
RATE = 0.3
CUTS = 32  # cut points tried for each feature

Leaf = float
Tree = tuple[int, float, object, object]  # feature, cut, tree or leaf below, from the cut on
Model = tuple[float, list[Tree]]


def _cut_points(x: np.ndarray) -> list[np.ndarray]:
    """Up to ``CUTS`` midpoints between the distinct values of each feature."""
    points = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middles = (values[1:] + values[:-1]) / 2
        step = max(1, math.ceil(len(middles) / CUTS))
        points.append(middles[step // 2 :: step])
    return points


def _best_cut(x, slope, bend, points) -> tuple[int, float] | None:
    best, chosen = 1e-9, None
    g_all, h_all = slope.sum(), bend.sum()
    for f, cuts in enumerate(points):
        if not len(cuts):
            continue
        place = np.searchsorted(cuts, x[:, f], side="right")  # cuts at or below the value
        g = np.cumsum(np.bincount(place, slope, len(cuts) + 1))[:-1]
        h = np.cumsum(np.bincount(place, bend, len(cuts) + 1))[:-1]
        gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
        at = int(gain.argmax())
        if gain[at] > best:
            best, chosen = float(gain[at]), (f, float(cuts[at]))
    return chosen


def _grow(x, slope, bend, points, depth: int):
    cut = _best_cut(x, slope, bend, points) if depth else None
    if cut is None:
        return float(RATE * slope.sum() / (bend.sum() + 1))
    feature, at = cut
    below = x[:, feature] < at
    low, high = (
        _grow(x[part], slope[part], bend[part], points, depth - 1) for part in (below, ~below)
    )
    return feature, at, low, high


def _values(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    feature, at, low, high = tree
    return np.where(x[:, feature] < at, _values(low, x), _values(high, x))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int = 3) -> Model:
    """Trees for the log loss; ``weight`` tells how often each row counts."""
    share = float((y * weight).sum() / weight.sum())
    share = min(max(share, 1e-3), 1 - 1e-3)
    bias, trees, points = math.log(share / (1 - share)), [], _cut_points(x)
    score = np.full(len(y), bias)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, weight * (y - p), weight * p * (1 - p), points, depth)
        trees.append(tree)
        score += _values(tree, x)
    return bias, trees


def predict(model: Model, x: np.ndarray) -> np.ndarray:
    """The chance of a yes."""
    bias, trees = model
    return 1 / (1 + np.exp(-(bias + sum(_values(tree, x) for tree in trees))))


def scoring(model: Model, features: Column) -> Column:
    """``predict`` in SQL, over an array of features."""
    bias, trees = model

    def value(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, at, low, high = tree
        return F.when(features[feature] < at, value(low)).otherwise(value(high))

    total = F.lit(bias)
    for tree in trees:
        total = total + value(tree)
    return 1 / (1 + F.exp(-total))
