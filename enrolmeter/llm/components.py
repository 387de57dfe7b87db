"""Connected components of a graph given as rows, by alternating star operations.

Each round asks for every node's least neighbour, in a table of its own beside a shuffled join,
so that a node with very many neighbours may be split. Once a graph has at most ``SMALL_GRAPH``
edges, which is counted in every round, they go through one task that joins trees: adaptive
execution would make one partition of so few bytes as well, and rounds of jobs would cost more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written


SMALL_GRAPH = 200_000


def _with_least(pairs: DataFrame, folder: str) -> DataFrame:
    """Each (node, other) with the node's least neighbour."""
    return pairs.join(written(pairs.groupBy("node").agg(F.min("other").alias("least")), folder), "node")


def _star(edges: DataFrame, folder: str) -> DataFrame:
    """Larger neighbours move to the least one around, then smaller ones do."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    large = _with_least(both, f"{folder}/large-least").where(F.col("other") > F.col("node"))
    large = large.select(F.col("other").alias("node"), F.least("node", "least").alias("other")).distinct()
    small = _with_least(written(large, f"{folder}/large"), f"{folder}/small-least")
    moved = small.where(F.col("other") != F.col("least")).select(F.col("other").alias("node"), "least")
    own = small.select("node", "least").distinct()
    return moved.unionByName(own).select("node", F.col("least").alias("other")).distinct()


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every node with the least one that its edges lead to."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        up = above.setdefault(node, node)
        while up != node:
            above[node] = above[up]
            node, up = up, above[up]
        return node

    for batch in batches:
        for node, other in zip(batch["node"].tolist(), batch["other"].tolist()):
            a, b = root(node), root(other)
            above[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(above), "label": [root(node) for node in above]}, dtype="int64")


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label): the least node of its component, for every node with an edge.

    Rounds grow with the logarithm of a component's diameter; each is written to the shared
    folder. Only a count and a checksum per round come back to the driver.
    """
    folder = scratch(edges.sparkSession, "components")
    now = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("other")
    ).distinct()
    now, seen, rounds = written(now, f"{folder}/0"), None, 0
    while True:
        found = now.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node, other))").alias("sum")
        ).first()
        if found["n"] <= SMALL_GRAPH:
            return now.coalesce(1).mapInPandas(_trees, "node long, label long")
        if found == seen:
            break
        seen, rounds = found, rounds + 1
        now = written(_star(now, f"{folder}/{rounds}"), f"{folder}/{rounds}/edges")
    roots = now.select(F.col("other").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select("node", F.col("other").alias("label")).unionByName(roots)
