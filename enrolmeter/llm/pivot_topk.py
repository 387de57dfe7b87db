"""Exact top-k search by inner product, with a pivot table for elimination.

Every vector has its distances to a few pivots worked out once. For a query q and a candidate x
the triangle inequality makes max over pivots p of |d(q,p) - d(x,p)| a lower bound b of d(q,x),
and since q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2, an upper bound of the score. Candidates are
evaluated in the order of that bound until it falls below the k-th best score found: what is
left cannot enter, not even by a tie. The origin is a pivot too, which is the bound |q| |x|.

Queries and candidates are both dealt to blocks by hash; each cell of the grid of blocks is one
group of bounded size, and every cell returns k rows per query, of which the k best are taken.
Only rows and the number of blocks grow with the input. Pivots are vectors of the data, one for
each of ``PIVOTS`` hash slots and dimension, for at most ``MOST_DIMENSIONS`` dimensions (vectors
of further dimensions have the origin alone): a bounded number reaches the driver.

Vectors are integers: floor(256 x) of each component, x as double. Scores are exact while they
stay below 2^53.

Defined cases: a vector that is null or holds null or non-finite components takes no part, nor
does a row without id. Rows with the same id are one vector, the smallest. Vectors of different
dimensions have no score. Equal scores go to the smaller id, extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, table, written

PIVOTS, MOST_DIMENSIONS = 16, 32
QUERY_BLOCK, CANDIDATE_BLOCK = 8192, 16384
STEP = 512


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): one integer vector per id, of the rows that take part."""
    doubles = F.col(column).cast("array<double>")
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(doubles, lambda x: F.floor(256 * x))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & fine)
    return rows.select(F.col("vec_id").cast("long"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by dimension: the origin, and a vector from each hash slot."""
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(PIVOTS))
    rows = (
        vectors.groupBy(F.size("v").alias("dim"), slot.alias("slot"))
        .agg(F.min(F.struct("vec_id", "v")).alias("first"))
        .orderBy("dim", "slot").limit(PIVOTS * MOST_DIMENSIONS).collect()
    )
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row["dim"], [np.zeros(row["dim"])]).append(np.array(row["first"]["v"], float))
    return {dim: np.stack(vs) for dim, vs in found.items()}


def _distances(batches, pivots: dict[int, np.ndarray]):
    for batch in batches:
        far = []
        for v in batch["v"]:
            mine = pivots.get(len(v))
            points = np.zeros((1, len(v))) if mine is None else mine
            far.append(np.sqrt(((points - np.asarray(v, float)) ** 2).sum(axis=1)))
        batch["far"] = far
        yield batch


def _cell(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of this cell for each of its queries."""
    asked = rows["asks"].to_numpy(bool)
    queries, others = rows[asked], rows[~asked]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(queries) and len(others):
        ids = others["vec_id"].to_numpy(np.int64)
        x = np.stack(others["v"].to_numpy()).astype(float)
        far = np.stack(others["far"].to_numpy())
        norms = (x * x).sum(axis=1)
        for query, v, mine in zip(queries["vec_id"], queries["v"], queries["far"]):
            out.append((np.int64(query), *_search(np.asarray(v, float), mine, query, ids, x, far, norms, k)))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return pd.DataFrame(
        {
            "query_id": np.concatenate([np.full(len(found), q) for q, found, _ in out]),
            "vec_id": np.concatenate([found for _, found, _ in out]),
            "score": np.concatenate([score for _, _, score in out]),
        }
    )


def _search(q, mine, query_id, ids, x, far, norms, k):
    """Candidates in the order of their bounds, until none can reach the k-th best."""
    gap = np.abs(far[:, 0] - mine[0])
    for p in range(1, len(mine)):
        np.maximum(gap, np.abs(far[:, p] - mine[p]), out=gap)
    # The slack covers the rounding of distances: bounds may only be too high.
    bound = (norms + q @ q - gap * gap) / 2
    bound += 1e-9 * (norms + q @ q) + 0.5
    order = np.argsort(-bound, kind="stable")
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    for i in range(0, len(order), STEP):
        some = order[i : i + STEP]
        if len(best) == k and bound[some[0]] < best[-1]:
            break
        some = some[ids[some] != query_id]
        best_ids, best = np.append(best_ids, ids[some]), np.append(best, x[some] @ q)
        top = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[top], best[top]
    return best_ids, best.astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each query."""
    whole = whole_vectors(vectors, column)
    pivots = choose_pivots(whole)
    ready = whole.mapInPandas(
        lambda batches: _distances(batches, pivots), "vec_id long, v array<long>, far array<double>"
    ).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    ready = written(ready, scratch(vectors.sparkSession, "pivot-table"))
    counts = ready.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks = {True: -(-counts["q"] // QUERY_BLOCK) or 1, False: -(-counts["n"] // CANDIDATE_BLOCK) or 1}

    def dealt(asks: bool) -> DataFrame:
        """Rows in their own block, once for each block of the other side."""
        own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks[asks])).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit(blocks[not asks] - 1)))
        names = ("q_block", "c_block") if asks else ("c_block", "q_block")
        rows = ready.where(F.col("asks")) if asks else ready
        return rows.select(
            "vec_id", "v", "far", F.lit(asks).alias("asks"), own.alias(names[0]), other.alias(names[1])
        ).withColumn("dim", F.size("v"))

    cells = dealt(True).unionByName(dealt(False)).groupBy("dim", "q_block", "c_block")
    found = cells.applyInPandas(lambda rows: _cell(rows, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH ok AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)])::BIGINT AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
