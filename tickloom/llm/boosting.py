"""Gradient boosting over counts of feature vectors; the trees become SQL expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS, DEPTH, RATE, LEAST_WEIGHT = 30, 3, 0.3, 1.0


class Split(NamedTuple):
    """Left if ``feature <= at``."""

    feature: int
    at: int
    left: Split | float
    right: Split | float


class Boosted(NamedTuple):
    """``sigmoid(slope * (start + sum of trees) + shift)`` is the calibrated probability."""

    start: float
    trees: tuple[Split | float, ...]
    slope: float
    shift: float

    def score(self, features: Sequence[Column]) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _expression(tree, features)
        return 1.0 / (1.0 + F.exp(-(total * self.slope + self.shift)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = self.start + sum((_values(t, x) for t in self.trees), np.zeros(len(x)))
        return 1.0 / (1.0 + np.exp(-(raw * self.slope + self.shift)))


def _expression(tree: Split | float, features: Sequence[Column]) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    left, right = _expression(tree.left, features), _expression(tree.right, features)
    return F.when(features[tree.feature] <= tree.at, left).otherwise(right)


def _values(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    return np.where(x[:, tree.feature] <= tree.at, _values(tree.left, x), _values(tree.right, x))


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int) -> Split | float:
    """The tree that lowers the second-order loss most, split by split."""
    g, h = grad.sum(), hess.sum()
    best, gain = None, 1e-6
    if depth:
        for feature in range(x.shape[1]):
            for at in np.unique(x[:, feature])[:-1].tolist():
                left = x[:, feature] <= at
                gl, hl = grad[left].sum(), hess[left].sum()
                won = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if won > gain:
                    best, gain = (feature, int(at), left), won
    if best is None:
        return float(-RATE * g / (h + 1))
    feature, at, left = best
    return Split(
        feature, at, _tree(x[left], grad[left], hess[left], depth - 1),
        _tree(x[~left], grad[~left], hess[~left], depth - 1),
    )


def fit(x: np.ndarray, good: np.ndarray, bad: np.ndarray, held: np.ndarray) -> Boosted:
    """Trees from rows of features with counts of good and bad cases.

    Rows marked ``held`` take no part in boosting; on them (on all, if there are none) the
    score is calibrated to a probability by a logistic fit.
    """
    learn = ~held if (~held).any() else np.ones(len(x), bool)
    xs, pos, neg = x[learn], good[learn].astype(float), bad[learn].astype(float)
    start = math.log((pos.sum() + 1) / (neg.sum() + 1))
    raw, trees = np.full(len(xs), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        total = pos + neg
        tree = _tree(xs, total * p - pos, total * p * (1 - p), DEPTH)
        trees.append(tree)
        raw += _values(tree, xs)
    model = Boosted(start, tuple(trees), 1.0, 0.0)
    check = held if held.any() else np.ones(len(x), bool)
    slope, shift = _calibrate(model, x[check], good[check].astype(float), bad[check].astype(float))
    return model._replace(slope=slope, shift=shift)


def _calibrate(model: Boosted, x: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[float, float]:
    raw = np.clip(model.start + sum((_values(t, x) for t in model.trees), np.zeros(len(x))), -15, 15)
    slope, shift = 1.0, 0.0
    # One good and one bad case at the score of even odds keep the fit finite.
    raw, pos, neg = np.append(raw, 0.0), np.append(pos, 1.0), np.append(neg, 1.0)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + shift, -30, 30)))
        g, h = (pos + neg) * p - pos, (pos + neg) * p * (1 - p) + 1e-9
        grad = np.array([(g * raw).sum() + 1e-3 * (slope - 1), g.sum() + 1e-3 * shift])
        hess = np.array([[(h * raw * raw).sum() + 1e-3, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -1, 1))
    return max(slope, 0.0), shift
