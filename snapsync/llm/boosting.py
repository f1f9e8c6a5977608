"""Gradient boosted trees over a small table of counted feature combinations."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Node:
    """A leaf with a value, or a question: is this feature one of these bins?"""

    value: float = 0.0
    feature: int = -1
    bins: tuple = ()
    yes: "Node | None" = None
    no: "Node | None" = None

    def column(self, names: list[str]) -> Column:
        if self.feature < 0:
            return F.lit(float(self.value))
        asked = F.col(names[self.feature]).isin(*self.bins)
        return F.when(asked, self.yes.column(names)).otherwise(self.no.column(names))

    def values(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        asked = np.isin(x[:, self.feature], self.bins)
        return np.where(asked, self.yes.values(x), self.no.values(x))


def _grow(x, gradient, weight, depth, ridge) -> Node:
    total, mass = gradient.sum(), weight.sum()
    leaf = Node(total / (mass + ridge))
    if depth == 0:
        return leaf
    best, gain = None, 1e-6
    for feature in range(x.shape[1]):
        bins, place = np.unique(x[:, feature], return_inverse=True)
        g, w = np.bincount(place, gradient), np.bincount(place, weight)
        order = np.argsort(g / (w + ridge), kind="stable")
        left_g, left_w = np.cumsum(g[order])[:-1], np.cumsum(w[order])[:-1]
        gains = (
            left_g**2 / (left_w + ridge)
            + (total - left_g) ** 2 / (mass - left_w + ridge)
            - total**2 / (mass + ridge)
        )
        if len(gains) and gains.max() > gain:
            cut = int(gains.argmax())
            gain = gains[cut]
            best = (feature, tuple(int(b) for b in sorted(bins[order[: cut + 1]])))
    if best is None:
        return leaf
    feature, bins = best
    asked = np.isin(x[:, feature], bins)
    parts = [_grow(x[m], gradient[m], weight[m], depth - 1, ridge) for m in (asked, ~asked)]
    return Node(0.0, feature, bins, *parts)


@dataclass
class Trees:
    base: float
    trees: list[Node]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.values(x) for t in self.trees), np.zeros(len(x)))

    def column(self, names: list[str]) -> Column:
        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + tree.column(names)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(x, positive, negative, rounds=24, depth=3, rate=0.3, ridge=1.0) -> Trees:
    """Logistic boosting with Newton leaves; rows are weighted by how often they were counted."""
    x = np.asarray(x, np.int64)
    positive, negative = np.asarray(positive, float), np.asarray(negative, float)
    share = (positive.sum() + 1) / (positive.sum() + negative.sum() + 2)
    model = Trees(float(np.log(share / (1 - share))), [])
    if not len(x):
        return model
    logits = np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logits))
        gradient = positive * (1 - p) - negative * p
        weight = (positive + negative) * p * (1 - p) + 1e-9
        tree = _grow(x, gradient, weight, depth, ridge)
        _scale(tree, rate)
        model.trees.append(tree)
        logits += tree.values(x)
    return model


def _scale(node: Node, rate: float) -> None:
    node.value *= rate
    for part in (node.yes, node.no):
        if part is not None:
            _scale(part, rate)


def threshold(p, positive, negative, precision: float) -> float:
    """The smallest score from which on the share of positives is at least `precision`; above 1
    where there is none."""
    order = np.argsort(-p, kind="stable")
    p, hits, misses = p[order], np.cumsum(positive[order]), np.cumsum(negative[order])
    last = np.append(p[1:] != p[:-1], True)
    good = last & (hits >= precision * (hits + misses)) & (hits > 0)
    return float(p[np.flatnonzero(good)[-1]]) if good.any() else 2.0
