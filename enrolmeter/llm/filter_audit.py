"""Filter interaction audit: what each filter removes in every order, and its Shapley value.

A document fails some of five filters, which is five bits. Per part (language) and combination
of bits documents are counted, and from those at most 32 counts a table of all 32 coalitions
follows: what each set of filters would remove together. Every answer is read off that table:

* Step counts are differences of coalitions. A filter after a set P of others removes
  v(P with it) - v(P); what else fails it, v(it alone) less that, is redundant there.
* Shapley values are the solution of a constrained least squares problem: the additive function of
  coalitions nearest to v, weighted by the kernel (n - 1) / (C(n, s) s (n - s)) for coalitions of
  size s, whose sum over all filters equals v(all). The normal equations with their multiplier
  are solved exactly, in rationals. Their matrix is the same for every part, so it is eliminated
  once, with a right-hand column for each coalition; times n! the solution is whole numbers, and
  Spark applies those to each part's table in exact integers.

Spark sees the texts once, in array functions. Only (id, hash of the text, bits) is shuffled: first by
all of it, then by id to meet the labels, then by text to find the least id of equal texts. Each
time rows are combined before, so a text that a third of all documents share, or an id that comes
very often, arrives as one row per task. The final tables have 32 rows a part.

Defined cases: null text is empty text, a null part is the empty string. A row without id has no
smaller one and is none; rows that repeat an id are counted each and do not fail for each other.
An id with several label rows has a mark that any of them sets. Without documents there is no
row. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_pair, let, table, text_of, words_of

#: The contract's bounds and characters.
LETTERS = "ABCDE"
FEWEST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, ODD_CHARACTERS = 200, 50, 3, "[#$%&*|]"


def of_text(text: Column) -> list[Column]:
    """The failure conditions that a text decides alone, A to D."""
    words = let(
        words_of(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"))
    )
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        words["n"] < FEWEST_WORDS,
        100 * words["distinct"] < DISTINCT_PERCENT * words["n"],
        100 * capitals > CAPITAL_PERCENT * F.char_length(text),
        F.regexp_like(text, F.lit(ODD_CHARACTERS)),
    ]


# --- coalitions --------------------------------------------------------------------------------


def shapley_shares(n: int) -> list[list[Fraction]]:
    """Row i: with what factor the value of each coalition (a bit set) enters filter i's value.

    Gauss-Jordan elimination of the normal equations, bordered by the efficiency constraint, with
    a right-hand column for each coalition.
    """
    size, everyone = n + 1, 2**n - 1
    rows = [[Fraction(0)] * (size + everyone + 1) for _ in range(size)]
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    for coalition in range(1, everyone):
        inside = [i for i in range(n) if coalition >> i & 1]
        weight = Fraction(n - 1, comb(n, len(inside)) * len(inside) * (n - len(inside)))
        for i in inside:
            rows[i][size + coalition] += weight
            for j in inside:
                rows[i][j] += weight
    rows[n][size + everyone] = Fraction(1)
    for i in range(size):
        pivot = next(r for r in range(i, size) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        scale = rows[i][i]
        rows[i] = [x / scale for x in rows[i]]
        for r in range(size):
            if r != i and rows[r][i]:
                factor = rows[r][i]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[i])]
    return [row[size:] for row in rows[:n]]


def whole_shares(n: int) -> list[list[int]]:
    """The same times n!: a sum over all orders, in whole numbers."""
    scaled = [[share * factorial(n) for share in row] for row in shapley_shares(n)]
    if any(share.denominator != 1 for row in scaled for share in row):
        raise ArithmeticError("shares of all orders must be whole")
    return [[int(share) for share in row] for row in scaled]


def coalitions(tally: DataFrame, n: int) -> DataFrame:
    """(part, n_docs, v): ``v[S]`` holds what coalition S removes: documents, good and toxic ones."""
    sets = F.explode(F.sequence(F.lit(0), F.lit(2**n - 1)))
    every = tally.select("part", "mask", "n", "good", "toxic", sets.alias("s"))
    hit = F.col("mask").bitwiseAND(F.col("s")) != 0
    removed = every.groupBy("part", "s").agg(
        F.sum("n").alias("n_docs"),
        *(F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")),
    )
    return removed.groupBy("part").agg(
        F.max("n_docs").alias("n_docs"), F.sort_array(F.collect_list(F.struct("s", "n", "good", "toxic"))).alias("v")
    )


def steps(table_of: DataFrame, letters: str) -> DataFrame:
    """Every order's steps, read off the coalitions of each part."""
    n = len(letters)
    names, before, own = [], [], []
    for order in permutations(range(n)):
        taken = 0
        for i in order:
            names.append("".join(letters[j] for j in order))
            before.append(taken)
            own.append(i)
            taken |= 1 << i
    shares = F.array(*(F.lit(row) for row in whole_shares(n)))
    value = F.array(*(
        F.aggregate(
            F.zip_with(F.transform("v", lambda x: x["n"]), F.get(shares, i), lambda a, b: a * b),
            F.lit(0).cast("long"), lambda total, x: total + x,
        )
        for i in range(n)
    ))
    alone = F.array(*(F.get("v", F.lit(1 << i))["n"] for i in range(n)))
    last = F.array(*(F.get("v", F.lit(2**n - 1))["n"] - F.get("v", F.lit(2**n - 1 - (1 << i)))["n"] for i in range(n)))
    at = table_of.select(
        "part", "n_docs", "v", value.alias("value"), alone.alias("alone"), last.alias("last"),
        F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1))).alias("at"),
    )
    at = at.select(
        "*", F.get(F.lit(names), "at").alias("filter_order"), (F.col("at") % n + 1).cast("int").alias("step"),
        F.get(F.lit(own), "at").alias("own"), F.get(F.lit(before), "at").alias("p"),
    )
    at = at.select(
        "*", F.get("v", "p").alias("b"),
        F.get("v", F.col("p").bitwiseOR(F.get(F.lit([1 << i for i in range(n)]), "own"))).alias("a"),
    )
    here = F.col("a.n") - F.col("b.n")
    return at.select(
        "part", "filter_order", "step",
        (F.col("n_docs") - F.col("a.n")).alias("kept"), here.alias("removed"),
        (F.get("alone", "own") - here).alias("redundant"), F.get("last", "own").alias("unique_fails"),
        (F.col("a.good") - F.col("b.good")).alias("good_lost"),
        (F.col("a.toxic") - F.col("b.toxic")).alias("toxic_lost"),
        F.get("value", "own").alias("shapley"),
    )


# --- documents ---------------------------------------------------------------------------------


def _mask(tests: Sequence[Column]) -> Column:
    bits = [F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)]
    return sum(bits[1:], bits[0])


def tally(
    docs: DataFrame, labels: DataFrame, part: str = "lang", tests: Callable[[Column], list[Column]] = of_text
) -> tuple[DataFrame, int]:
    """(part, mask, n, good, toxic): documents by the filters they fail, and the number of filters.

    The last filter is that of texts which a smaller id has as well.
    """
    own = tests(text_of())
    h1, h2 = hash_pair(text_of())
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        h1.alias("h1"), h2.alias("h2"), _mask(own).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "h1", "h2", "mask").agg(F.count("*").alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in ("quality", "toxic"))
    )
    rows = rows.join(marks, "doc_id", "left").select(
        *rows.columns, *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("quality", "toxic"))
    )
    known = F.col("doc_id").isNotNull()
    # Per text as many rows as parts and marks it comes with.
    texts = rows.groupBy("h1", "h2", "part", "mask", "quality", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("without"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("h1", "h2"))
    texts = texts.withColumn("least", least)
    leads = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    passing = F.col("without") + leads
    copied = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + (1 << len(own))).alias("mask"), (F.col("n") - passing).alias("n")),
    ))
    found = texts.select("part", "quality", "toxic", copied.alias("c")).where(F.col("c.n") > 0)
    n = F.col("c.n")
    counted = found.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("quality"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )
    return counted, len(own) + 1


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row for each part, order of the filters and step in it."""
    counted, n = tally(docs, labels, part)
    return steps(coalitions(counted, n), LETTERS[:n])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS words
  FROM documents),
mark AS (
  SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS fails
  FROM d LEFT JOIN mark USING (doc_id)),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
         list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(filter_order, k, 1)) - 65))) AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
every AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (fails & (own | coalesce(earlier, 0)::INT) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (fails & own <> 0 AND fails & coalesce(earlier, 0)::INT = 0), 0) AS removed,
         coalesce(sum(n) FILTER (fails & own <> 0 AND fails & coalesce(earlier, 0)::INT <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (fails & own <> 0 AND fails & coalesce(earlier, 0)::INT = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (fails & own <> 0 AND fails & coalesce(earlier, 0)::INT = 0), 0) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM every
"""
