"""A corpus pipeline of five stages over ``documents``.

Each stage works on all rows that its predecessor kept and is written as Parquet before the
next one reads it. The first four return the columns of ``documents``; the last adds tokens.

1. Quality: documents that the network trained on ``labels`` scores below 0.7 go.
2. Lines: repeated lines go from all documents but the largest id; ``n_chars`` follows the text.
   A document that loses all its lines stays, empty.
3. Near-duplicates (five-word shingles, 0.8): the least id of each group stays.
4. Mixing: documents are replicated to the target weights and shuffled.
5. Tokens: ``ids`` by the public byte-level vocabulary, and whether they decode to the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrolmeter.llm import bpe, line_dedup, minmax_dedup, mixing, quality_net
from enrolmeter.llm.common import scratch, table, text_of, without, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: What the operators of the stages read. All else passes under names that they do not use.
READ = ("doc_id", "text", "source")


def _apart(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """The columns of ``docs``, and ``added`` ones, after an operator that adds columns of its own."""
    names = {c: c if c in READ else f"own_column_{i}" for i, c in enumerate(docs.columns)}
    done = operator(docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items())))
    return done.select(*(F.col(name).alias(c) for c, name in names.items()), *added)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_net.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_net.probability(model) >= quality_net.THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = _apart(docs, line_dedup.dedup_lines)
    length = F.char_length("text").cast("long")
    return kept.withColumn("n_chars", length) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, lambda d: minmax_dedup.group_near_duplicates(d).where("kept"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, lambda d: mixing.mix(d, mixing.WEIGHTS, mixing.REST))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(docs.select(F.struct(*docs.columns).alias("row"), "text"), public_tokenizers.path(bpe.VOCABULARY))
    same = F.col("decoded") == text_of().cast("binary")
    own = without(docs, "n_tokens", "ids", "round_trip")
    return coded.select(
        *(f"row.{c}" for c in own), F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
