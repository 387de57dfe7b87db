"""Gradient boosting of small trees for a yes/no question: in numpy, or over the rows of a table.

Over a table every level of a tree is one job: tasks add up the derivatives of all rows by model,
node, feature and bin, Spark sums these, and the driver picks the splits from at most
models x nodes x features x ``BINS`` sums. Derivatives are added as whole numbers of 1 / ``UNIT``,
so the order of rows and partitions changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
UNIT = float(1 << 24)


@dataclass
class Tree:
    """A complete binary tree: feature and edge of each inner node, value of each leaf."""

    features: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = node < len(self.features)
            if not inner.any():
                return node - len(self.features)
            at = node[inner]
            right = x[inner, self.features[at]] > self.edges[at]
            node[inner] = 2 * at + 1 + right

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.values[self.leaves(x)]


@dataclass
class Boosted:
    """A sum of trees as log odds."""

    base: float
    trees: list[Tree] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.predict(x)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_split(sums_g, sums_h, g: float, h: float, edges, ridge: float) -> tuple[float, int, float]:
    """(gain, feature, edge) of the best split by the sums of every feature's bins; (1e-9, 0, inf): none."""
    best, whole = (1e-9, 0, np.inf), g**2 / (h + ridge)
    for f, own in enumerate(edges):
        left_g, left_h = sums_g[f].cumsum()[: len(own)], sums_h[f].cumsum()[: len(own)]
        right_g, right_h = g - left_g, h - left_h
        fair = (left_h > 1e-3) & (right_h > 1e-3)
        gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - whole
        gain = np.where(fair, gain, 0)
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), f, own[gain.argmax()])
    return best


def _grow(x, binned, edges, slope, curve, depth: int, rate: float, ridge: float) -> Tree:
    inner = 2**depth - 1
    features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    for at in range(inner):
        mine = np.flatnonzero(node == at)
        best = (1e-9, 0, np.inf)
        if len(mine) > 1:
            g, h = slope[mine], curve[mine]
            sums = ([np.bincount(binned[mine, f], v, BINS) for f in range(x.shape[1])] for v in (g, h))
            best = _best_split(*sums, g.sum(), h.sum(), edges, ridge)
        features[at], cuts[at] = best[1:]
        node[mine] = 2 * at + 1 + (x[mine, features[at]] > cuts[at])
    leaf = node - inner
    g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
    return Tree(features, cuts, -rate * g / (h + ridge))


def boost(
    x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0
) -> Boosted:
    """Trees one after the other, each on the first and second derivatives of the log loss."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Boosted(float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)))[:-1] for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(y), model.base)
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        tree = _grow(x, binned, edges, guess - y, guess * (1 - guess), depth, rate, ridge)
        model.trees.append(tree)
        total += tree.predict(x)
    return model


# --- over a table --------------------------------------------------------------------------------


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)


def _level_sums(rows: DataFrame, models: list[Boosted], open_trees: list[Tree], level: int, edges) -> np.ndarray:
    """Sums of both derivatives by model, node of the level, feature and bin, over all rows."""
    width, nodes = len(edges), 2**level
    shape = (2, len(models), nodes, width, BINS)

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(shape)
        for batch in batches:
            if not len(batch):
                continue
            x, y = np.array(batch["features"].tolist()), batch["y"].to_numpy()
            weight, fold, binned = batch["weight"].to_numpy(), batch["fold"].to_numpy(), _binned(x, edges)
            for m, (model, tree) in enumerate(zip(models, open_trees)):
                mine = np.flatnonzero(fold != m)
                own, node = x[mine], np.zeros(len(mine), np.int64)
                for _ in range(level):
                    node = 2 * node + 1 + (own[np.arange(len(mine)), tree.features[node]] > tree.edges[node])
                guess = model.probability(own)
                place = ((node - nodes + 1)[:, None] * width + np.arange(width)) * BINS + binned[mine]
                for k, values in enumerate((guess - y[mine], guess * (1 - guess))):
                    whole = np.rint(values * weight[mine] * UNIT)
                    sums[k, m] += np.bincount(place.ravel(), np.repeat(whole, width), nodes * width * BINS).reshape(shape[2:])
        flat = sums.ravel()
        at = np.flatnonzero(flat)
        yield pd.DataFrame({"place": at, "sum": flat[at].astype(np.int64)})

    found = rows.mapInPandas(added, "place long, sum long").groupBy("place").agg(F.sum("sum").alias("sum")).toPandas()
    flat = np.zeros(int(np.prod(shape)))
    flat[found["place"].to_numpy(np.int64)] = found["sum"].to_numpy(np.float64) / UNIT
    return flat.reshape(shape)


def boost_table(
    rows: DataFrame, edges: list[np.ndarray], folds: int,
    rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0,
) -> list[Boosted]:
    """A model without the rows of each fold, and last one of all ``rows`` (features, y, weight, fold)."""
    shares = rows.groupBy("fold", "y").agg(F.sum(F.rint(F.col("weight") * UNIT).cast("long")).alias("w")).collect()
    models = []
    for m in range(folds + 1):
        good, every = (sum(r["w"] for r in shares if r["fold"] != m and r["y"] >= low) / UNIT for low in (1, 0))
        share = (good + 1) / (every + 2)
        models.append(Boosted(float(np.log(share / (1 - share)))))
    inner = 2**depth - 1
    for _ in range(rounds):
        trees = [Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)) for _ in models]
        for level in range(depth):
            sums_g, sums_h = _level_sums(rows, models, trees, level, edges)
            for m, tree in enumerate(trees):
                for k in range(2**level):
                    at, hist_g, hist_h = 2**level - 1 + k, sums_g[m, k], sums_h[m, k]
                    g, h = hist_g[0].sum(), hist_h[0].sum()
                    _, f, cut = _best_split(hist_g, hist_h, g, h, edges, ridge)
                    tree.features[at], tree.edges[at] = f, cut
                    if level == depth - 1:  # the leaves are the two sides of the last split
                        left = len(edges[f]) if np.isinf(cut) else int(np.searchsorted(edges[f], cut))
                        left_g, left_h = hist_g[f, : left + 1].sum(), hist_h[f, : left + 1].sum()
                        tree.values[2 * k] = -rate * left_g / (left_h + ridge)
                        tree.values[2 * k + 1] = -rate * (g - left_g) / (h - left_h + ridge)
        for model, tree in zip(models, trees):
            model.trees.append(tree)
    return models
