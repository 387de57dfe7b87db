"""Importance resampling towards a target distribution, on hashed word runs.

Features of a text are its runs of one to three words. A feature's bucket is the CRC-32 of its
bytes modulo ``BUCKETS``. How much more often a bucket comes in the target texts than in the
documents is its gain; a document's weight is the sum over its features, and a hash of its id adds
Gumbel noise, so that the highest scores are a sample without replacement in proportion to exp(weight).

CRCs go by length-bucketed matrices. In a piece of text (about ``PIECE`` bytes) words are numbered
by a dictionary and runs by pairs of numbers, which leaves the distinct features; those of equal length
are gathered into one two-dimensional uint8 array, a row each, and all their CRCs advance column by
column, one table look-up a column. Results are scattered back through the numbering. A feature
over ``WIDE`` bytes (text without spaces) becomes a matrix itself: zeros in front, which a register of zero
passes over, fill it up to rows of ``WIDE`` bytes; the rows' registers are then chained by the effect of
``WIDE`` zero bytes, which is linear.

Spark maps over the texts twice, once to count buckets and once to weigh documents; each task
returns at most BUCKETS sums, resp. three numbers a document. No text is shuffled. The driver
receives BUCKETS sums of both sides. Ranks come from a sort by range that carries ids and scores: its
partitions are numbered on, from the rows in each. A text longer than a piece is cut between words
and two words are carried over the cut, so the memory of a task does not depend on a text's length (a
single word's apart).

Defined cases: null text has no words, weight 0 and no features. A row without id has no score and
takes no part in the draw. Rows that repeat an id have the same noise; ties go by id, then by
number of features. Without documents there is no row; without target texts all gains follow from zero
counts. Columns of the same names as the results are replaced, others come back as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import scratch, table, text_of, without, written

#: The contract's buckets, run lengths, least words, percentage, seed; the CRC's polynomial.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
POLYNOMIAL = 0xEDB88320
#: Bytes of a piece, of a feature that is a row, and of a matrix.
PIECE, WIDE, MATRIX = 1 << 20, 256, 1 << 20


# --- CRCs by columns ---------------------------------------------------------------------------


def _step_table() -> np.ndarray:
    registers = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        registers = (registers >> np.uint32(1)) ^ (registers & np.uint32(1)) * np.uint32(POLYNOMIAL)
    return registers


_STEP = _step_table()


def _advance(registers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The registers after all bytes of their rows, one column after the other."""
    for column in np.ascontiguousarray(rows.T):
        registers = _STEP.take(registers.astype(np.uint8) ^ column) ^ (registers >> np.uint32(8))
    return registers


#: What WIDE zero bytes make of a register, for each value of each of its four bytes.
_OVER = [
    _advance(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), np.zeros((256, WIDE), np.uint8)).tolist()
    for k in range(4)
]


def _long_crc(data: np.ndarray) -> int:
    """Of one feature of more than WIDE bytes."""
    padded = np.zeros(-(-len(data) // WIDE) * WIDE, np.uint8)
    padded[len(padded) - len(data) :] = data
    first = len(padded) - len(data)
    padded[first : first + 4] ^= 0xFF  # the register's first value, moved into the data
    rows = padded.reshape(-1, WIDE)
    total = 0
    for register in _advance(np.zeros(len(rows), np.uint32), rows).tolist():
        total = _OVER[0][total & 255] ^ _OVER[1][total >> 8 & 255] ^ _OVER[2][total >> 16 & 255] ^ _OVER[3][total >> 24]
        total ^= register
    return total ^ 0xFFFFFFFF


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start : start + length]`` for each (at least one byte long)."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:]):
        length = int(lengths[order[low]])
        if length > WIDE:
            for i in order[low:high]:
                out[i] = _long_crc(data[starts[i] : starts[i] + length])
            continue
        windows = np.lib.stride_tricks.sliding_window_view(data, length)
        for some in range(low, high, max(1, MATRIX // length)):
            rows = order[some : min(high, some + max(1, MATRIX // length))]
            first = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            out[rows] = ~_advance(first, windows[starts[rows]])
    return out


# --- features of texts -------------------------------------------------------------------------


def _folding() -> bytes:
    """Letters in lower case; what belongs to no word is a space."""
    fold = [i if i >= 128 or chr(i).isdigit() or chr(i).islower() else 32 for i in range(256)]
    fold[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    return bytes(fold)


_FOLD = _folding()


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, int]]:
    """(bytes, where each text starts in them, which text that is, words carried over) of all texts."""
    waiting, starts, numbers, size = [], [], [], 0
    for number, text in enumerate(texts):
        folded = text.translate(_FOLD)
        if size and size + len(folded) > PIECE:
            yield b"".join(waiting), np.array(starts), np.array(numbers), 0
            waiting, starts, numbers, size = [], [], [], 0
        if len(folded) > PIECE:
            at, carried = 0, b""
            while at < len(folded):
                stop = folded.find(b" ", at + PIECE)
                stop = len(folded) if stop < 0 else stop
                part = carried + folded[at:stop]
                yield part, np.array([0]), np.array([number]), len(carried.split())
                carried, at = b"".join(w + b" " for w in part.rsplit(None, LONGEST - 1)[1 - LONGEST :]), stop
            continue
        waiting.append(folded)
        starts.append(size)
        numbers.append(number)
        size += len(folded)
    if waiting:
        yield b"".join(waiting), np.array(starts), np.array(numbers), 0


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a run, text number, bucket) of all features, piece by piece."""
    for data, text_starts, numbers, carried in _pieces(texts):
        raw = np.frombuffer(data, np.uint8)
        inside = raw != 32
        fresh = np.zeros(len(raw) + 1, bool)  # where a text starts, words do not go on
        fresh[text_starts] = True
        begins = np.flatnonzero(inside & (fresh[:-1] | ~np.append(False, inside[:-1])))
        ends = np.flatnonzero(inside & (fresh[1:] | ~np.append(inside[1:], False))) + 1
        if not len(begins):
            continue
        owner = np.searchsorted(text_starts, begins, "right") - 1
        # All words with one space after each: a run of words is a stretch of this.
        sizes = ends - begins
        offsets = np.zeros(len(begins) + 1, np.int64)
        np.cumsum(sizes + 1, out=offsets[1:])
        joined = np.full(offsets[-1], 32, np.uint8)
        joined[np.arange(sizes.sum()) + np.repeat(np.arange(len(begins)), sizes)] = raw[inside]
        words = pa.Array.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
        ).dictionary_encode()
        word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, codes, last = len(words.dictionary), word, np.arange(len(begins))
        for k in range(1, LONGEST + 1):
            if k > 1:
                # Runs of one word more, numbered by what they were and the word they gain.
                follows = last[last + 1 < len(word)] + 1
                same = owner[follows] == owner[follows - k + 1]
                before, last = codes[: len(follows)][same], follows[same]
                codes = pd.factorize(before * kinds + word[last])[0]
            some = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
            some[codes] = last
            start = offsets[some - k + 1]
            found = crcs(joined, start, offsets[some + 1] - 1 - start) % BUCKETS
            counted = last >= carried
            yield k, numbers[owner[last[counted]]], found[codes[counted]].astype(np.int64)


def _bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.large_binary()).to_pylist()


# --- the operator ------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums: one row for each bucket it has met."""
    sums = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, buckets in features(_bytes(batch.column(0))):
            sums += np.bincount(buckets, minlength=BUCKETS)
    met = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(sums[met])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all ``text`` rows fall into each bucket."""
    found = texts.select(text_of().alias("text")).where("text <> ''").mapInArrow(_counted, "bucket int, n long")
    sums = np.zeros(BUCKETS, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        sums[row["bucket"]] = row["n"]
    return sums


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of both smoothed shares, rounded down, by bucket."""
    every, wanted = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((target + 1.0) * every) / ((source + 1.0) * wanted)
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios.tolist()], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score``."""
    names = ("n_words", "n_features", "weight")

    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(len(batch), np.int64) for _ in names)
            for k, owner, buckets in features(_bytes(batch)):
                here = np.bincount(owner, minlength=len(batch))
                n_features += here
                n_words += here if k == 1 else 0
                np.add.at(weight, owner, gains[buckets])
            yield pa.StructArray.from_arrays([pa.array(x) for x in (n_words, n_features, weight)], names)

    measured.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Not deterministic to Spark: a filter on a result must not have it computed twice.
    measure = arrow_udf(measured, "n_words long, n_features long, weight long").asNondeterministic()
    own = without(docs, *names, "score")
    rows = docs.select(F.struct(*docs.columns).alias("row"), measure(text_of()).alias("m"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("row.doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.select(
        *(f"row.{c}" for c in own), *(f"m.{c}" for c in names), (F.col("m.weight") + noise).alias("score")
    )


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... in the highest ``percent`` of the documents with enough words.

    All columns given travel through one sort by range; select those that are wanted.
    """
    spark = scored.sparkSession
    own = without(scored, "rank", "row_at", "takes_part")
    takes_part = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    order = [F.desc("takes_part"), F.desc("score"), F.col("doc_id").asc(), F.col("n_features").asc()]
    folder = scratch(spark, "drawn")
    # A table first: a sort by range looks at its input twice, and texts are weighed once.
    rows = written(scored.select(*own, takes_part.alias("takes_part")), f"{folder}/scored").orderBy(*order)
    # The number of the partition, and that of the row in it, as the sort has left them.
    rows = written(rows.withColumn("row_at", F.monotonically_increasing_id()), f"{folder}/sorted")
    part, inside = F.shiftright("row_at", 33), F.col("row_at").bitwiseAND((1 << 33) - 1)
    parts = rows.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.sum(F.col("takes_part").cast("long")).alias("fit")
    ).orderBy("part").collect()  # a row for each partition of the sort
    limit, before, firsts = percent * sum(p["fit"] for p in parts) // 100, 0, []
    for p in parts:
        if before < limit:
            firsts.append((p["part"], before))
        before += p["n"]
    firsts = F.broadcast(spark.createDataFrame(firsts, "drawn_part long, drawn_before long"))
    rank = F.col("drawn_before") + inside + 1
    return rows.join(firsts, part == F.col("drawn_part"), "left").select(
        *own, F.when(F.col("takes_part") & (rank <= limit), rank).alias("rank")
    )


def op11_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gains = gains_of(bucket_counts(docs), bucket_counts(table(spark, sf_dir, "benchmark")))
    scored = weigh(docs, gains).select("doc_id", "n_words", "n_features", "weight", "score")
    return draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
placed AS (SELECT side, id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
runs AS (
  SELECT side, id, array_to_string(w[i:i + k - 1], ' ') AS f
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM placed) WHERE i + k - 1 <= len(w)),
feature AS (SELECT side, id, f, count(*) AS n FROM runs GROUP BY side, id, f),
bucket AS (
  SELECT f, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(
        regexp_extract_all(hex(encode(f)), '..'),
        lambda x: list_transform(range(8), lambda k: (('0x' || x)::BIGINT >> k) & 1)))),
      lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM feature)),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM feature JOIN bucket USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts),
weight AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM feature JOIN bucket USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
         coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weight USING (id) WHERE side = 'd'),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked r ON s.doc_id = r.doc_id
"""
