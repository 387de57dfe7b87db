"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its target share of the output's characters over its
characters in the input. A document's number of copies is the inverse of that Poisson
distribution at a uniform number hashed from a seed and the document's id, so it is the same in
every run and on every machine. Each document is exploded by its count, and the copies are
dealt to partitions and sorted there by a second hash, a global shuffle.

Only the sums of the named sources reach the driver: as many rows as the weights that the
caller wrote down, and one for all other sources. The table of distributions has as many rows;
it is broadcast up to ``SMALL_TABLE`` of them and joined by shuffle beyond. A source with a third
of all rows is one row per task in the sums and needs no shuffle in the look-up.

A mean above ``SPLIT_MEAN`` is drawn as a sum of equal independent Poisson parts, each from its
own hash: that is the same distribution and keeps ``exp(-mean)`` away from underflow.

Defined cases: null text has no characters, but every document weighs one more than its
characters, so an empty source has a rate. A null or unnamed source belongs to the rest. A
document without id is drawn by its text. Repeated rows are drawn alike, each with its own
copies. Other columns come back as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of, without

#: Target shares of the registered query and the pipeline: one large source, the rest even.
WEIGHTS = {"src0": 0.2} | {f"src{i}": 0.04 for i in range(1, 20)}
REST = 0.04
SEED = 2024
SMALL_TABLE = 1000
SPLIT_MEAN = 64.0


def repetition_rates(
    docs: DataFrame, weights: Mapping[str, float], rest: float, epochs: float, source: str = "source"
) -> dict[str | None, float]:
    """Mean copies per document of each named source present; None stands for the rest."""
    group = F.when(F.col(source).isin(list(weights)), F.col(source))
    sums = (
        docs.select(group.alias("g"), (F.char_length(text_of()) + 1).cast("long").alias("size"))
        .groupBy("g").agg(F.sum("size").alias("size")).collect()
    )
    sizes = {row["g"]: row["size"] for row in sums}
    shares = {g: weights[g] if g is not None else rest for g in sizes}
    whole, target = sum(sizes.values()), math.fsum(shares.values())
    return {g: shares[g] / target * whole * epochs / size if target else 0.0 for g, size in sizes.items()}


def _distributions(spark: SparkSession, rates: Mapping[str | None, float]) -> DataFrame:
    """(of_source, parts, cdf): the cumulative Poisson distribution of one part's mean."""
    rows = [(g, max(1, math.ceil(rate / SPLIT_MEAN)), rate) for g, rate in rates.items()]
    given = spark.createDataFrame(rows, "of_source string, parts int, rate double")
    mean = F.col("rate") / F.col("parts")
    # Twelve deviations and thirty more: what lies beyond is below the step of a double.
    terms = (mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda acc: acc["cdf"])
    return given.select("of_source", "parts", cdf.alias("cdf"))


def _uniform(seed: int, key: Column, part: Column) -> Column:
    """52 hashed bits as a number from 0 to below 1."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float],
    rest: float = 0.0,
    epochs: float = 1.0,
    seed: int = SEED,
    source: str = "source",
) -> DataFrame:
    """``docs`` replicated to the weights and shuffled, with ``copy`` (from 0) and
    ``shuffle_key``, the order within a partition."""
    spark = docs.sparkSession
    rates = repetition_rates(docs, weights, rest, epochs, source)
    known = _distributions(spark, rates)
    if len(rates) <= SMALL_TABLE:
        known = F.broadcast(known)
    columns = without(docs, "copy", "shuffle_key")
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("row.text", F.lit("")))))
    group = F.when(F.col(f"row.{source}").isin(list(weights)), F.col(f"row.{source}"))
    drawn = F.transform(
        F.sequence(F.lit(1), F.col("parts")),
        lambda part: F.size(F.filter("cdf", lambda c: c <= _uniform(seed, F.col("doc_key"), part))),
    )
    copies = F.aggregate(drawn, F.lit(0), lambda n, k: n + k)
    return (
        docs.select(F.struct(*columns).alias("row"))
        .withColumn("doc_key", key)
        .join(known, group.eqNullSafe(F.col("of_source")), "inner")
        .select("row", "doc_key", F.posexplode(F.array_repeat(F.lit(0), copies)).alias("copy", "_"))
        .select(
            "row.*", "copy",
            F.substring(
                F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), "doc_key", F.col("copy").cast("string"))), 1, 16
            ).alias("shuffle_key"),
        )
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, REST)


def _oracle() -> str:
    shares = ", ".join(f"('{g}', {w!r}::DOUBLE)" for g, w in WEIGHTS.items())
    return f"""
WITH RECURSIVE weight(g, w) AS (VALUES {shares}),
d AS (SELECT documents.*, weight.g FROM documents LEFT JOIN weight ON source = g),
size AS (SELECT g, sum(length(coalesce(text, '')) + 1)::DOUBLE AS n FROM d GROUP BY g),
share AS (
  SELECT size.g, n, coalesce(w, {REST!r}::DOUBLE) AS w FROM size LEFT JOIN weight ON size.g = weight.g),
rate AS (
  SELECT g, w / (SELECT round(sum(w), 9) FROM share) * (SELECT sum(n) FROM share) / n AS lam FROM share),
cdf(g, lam, k, p, c) AS (
  SELECT g, lam, 0, exp(-lam), exp(-lam) FROM rate
  UNION ALL
  SELECT g, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) FROM cdf WHERE k < lam + 12 * sqrt(lam) + 30),
table_of AS (SELECT g, list(c ORDER BY k) AS cs FROM cdf GROUP BY g),
drawn AS (
  SELECT d.* EXCLUDE (g),
         len(list_filter(cs, lambda c: c <=
           ('0x' || substr(md5('{SEED}:' || doc_id || ':1'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)) AS n
  FROM d JOIN table_of t ON d.g IS NOT DISTINCT FROM t.g),
copied AS (SELECT * EXCLUDE (n), unnest(range(n))::INTEGER AS copy FROM drawn)
SELECT *, substr(md5('{SEED}:order:' || doc_id || ':' || copy), 1, 16) AS shuffle_key FROM copied
"""


ORACLE = _oracle()
