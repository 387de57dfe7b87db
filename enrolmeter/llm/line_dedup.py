"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

A line's key is the line without surrounding white space and with A-Z in lower case. A key of
enough code points found in at least ``limit`` documents loses all its lines but those of the
largest ``doc_id`` that holds it.

How: the hashes of all lines are written once, dealt into batches by descending ``doc_id``.
Each batch is reduced to one row per hash (documents, largest document), merge-anti-joined
with the runs written so far, and its remainder becomes a sorted run of level 0. The anti-join
leaves out hashes that a run already holds with enough documents and a document at least as
large: such a row could change nothing, and with descending batches that is every repeat of a
settled boilerplate line. When a level has ``fanout`` runs they are merged into one run of the
next level. In the end the merged runs tell which (document, line) pairs go.

Only hashes, ids and positions are shuffled by line; texts meet their document's list of
positions once, on the document's key. A line that a third of all documents hold arrives
pre-aggregated where it is counted; where it is looked up, the line side of the join is the one
that adaptive execution splits.

Defined cases: null text is empty text, one empty line. A row without ``doc_id`` counts as no
document and keeps its lines. Rows with the same ``doc_id`` count as one document and are each
returned. Other columns come back as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    hash_pair, hex_sha256, lines_of, lower_ascii, scratch, stripped, table, text_of, without, without_lines,
    written,
)

HASH = ["h1", "h2"]


@dataclass
class LineRuns:
    """Sorted runs of (hash, documents, largest document), in levels of ``fanout`` runs.

    Every document belongs to one batch, so document counts of several runs add up.
    """

    spark: SparkSession
    folder: str
    limit: int = 3
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=list)
    made: int = 0

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (h1, h2, doc_id): what the runs do not settle becomes a run."""
        batch = lines.groupBy(*HASH).agg(
            F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        if self.levels:
            settled = self._rows().where(F.col("n_docs") >= self.limit)
            settled = settled.select(*HASH, F.col("last_doc").alias("settled_by"))
            adds_nothing = (
                (batch["h1"] == settled["h1"])
                & (batch["h2"] == settled["h2"])
                & (settled["settled_by"] >= batch["last_doc"])
            )
            batch = batch.join(settled, adds_nothing, "left_anti")
        self._store(batch, 0)

    def merged(self) -> DataFrame:
        """One row per hash over all runs."""
        return self._merge(self._rows())

    def _rows(self, paths: list[str] | None = None) -> DataFrame:
        paths = [p for level in self.levels for p in level] if paths is None else paths
        return self.spark.read.schema("h1 long, h2 long, n_docs long, last_doc long").parquet(*paths)

    def _merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*HASH).agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
        )

    def _store(self, rows: DataFrame, level: int) -> None:
        path = f"{self.folder}/level={level}/run={self.made}"
        self.made += 1
        rows.sortWithinPartitions(*HASH).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._store(self._merge(self._rows(full)), level + 1)


def _line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of every line that is long enough to count."""
    h1, h2 = hash_pair(F.col("key"))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(text_of()).alias("text_hash"),
            F.posexplode(lines_of(lower_ascii(text_of()))).alias("pos", "line"),
        )
        .select("doc_id", "text_hash", "pos", stripped(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", h1.alias("h1"), h2.alias("h2"))
    )


def _dealt(lines: DataFrame, ids: DataFrame, batches: int) -> tuple[DataFrame, int]:
    """Give each line the batch of its document, largest ids first, batches about equal."""
    shares = [i / batches for i in range(1, batches)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 1000).alias("q")).first()["q"] if shares else []
    edges = sorted(set(found or []), reverse=True)
    batch: Column = F.lit(len(edges))
    for number in reversed(range(len(edges))):
        batch = F.when(F.col("doc_id") > edges[number], number).otherwise(batch)
    return lines.withColumn("batch", batch), len(edges) + 1


def dedup_lines(
    docs: DataFrame, limit: int = 3, min_chars: int = 20, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` and ``n_dropped``."""
    spark = docs.sparkSession
    folder = scratch(spark, "lines")
    texts = docs.select("doc_id", "text")
    lines, n = _dealt(_line_rows(texts, min_chars), texts.select("doc_id"), batches)
    lines = written(lines, f"{folder}/lines", "batch")
    runs = LineRuns(spark, f"{folder}/runs", limit, fanout)
    for number in range(n):
        runs.add(lines.where(F.col("batch") == number))

    frequent = runs.merged().where(F.col("n_docs") >= limit).select(*HASH, "last_doc")
    # A table, not an aggregate, beside the join: then a hot line's partition may be split.
    frequent = written(frequent, f"{folder}/frequent")
    drops = (
        lines.drop("batch").join(frequent, HASH)
        .where(F.col("doc_id") != F.col("last_doc"))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
        .select(F.col("doc_id").alias("drop_id"), F.col("text_hash").alias("drop_hash"), "dropped")
    )
    packed = docs.select(F.struct(*without(docs)).alias("row"), F.struct(text_of().alias("text")).alias("full"))
    met = packed.join(
        drops,
        (F.col("row.doc_id") == F.col("drop_id"))
        & (F.xxhash64(F.col("full.text")) == F.col("drop_hash")),
        "left",
    )
    text, dropped = F.col("full.text"), F.col("dropped")
    others = [f"row.{c}" for c in without(docs, "text", "n_lines", "n_dropped")]
    return met.select(
        *others,
        without_lines(text, dropped).alias("text"),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", hex_sha256(F.col("text")).alias("kept_sha256")
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last_doc AS dropped
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
