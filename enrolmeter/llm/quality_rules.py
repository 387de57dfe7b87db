"""Quality rules: word and line statistics, then cross-document line frequency per host.

Statistics of a text are computed in its own row with array functions, so no word ever leaves
its document. A window of five words is one 64-bit hash; only texts in which some window comes
twice sort their windows and measure what the repeated ones cover.

The method's verdict: a line's key is the line without surrounding white space and with A-Z in
lower case. A line is boilerplate when more than ``line_limit`` distinct documents of one host
hold it and these are more than ``host_percent`` of the host's documents: the first keeps chance
repeats of small hosts, the second those of large ones. Boilerplate lines are taken away, and a
document is depleted, hence rejected, when less than ``min_left_percent`` of its words are left.
Every document counts, so a text copied often enough within its host goes with all its copies;
``copies_count=False`` counts documents with equal texts as one holder of their lines instead.

Counting goes through partial aggregates, so a line held by a third of a host's documents, or
a host with a third of all documents, arrives as one row per task; the look-up keeps the lines
on the side that adaptive execution may split.

Defined cases: null text has no words and fails. A null host is a host of its own. Documents
without id are told apart by their texts. A repeated row is the same document and judged like its
twin. Columns of the results' names are replaced, others come back as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    SPACE_RUN, hash_pair, let, lines_of, lower_ascii, scratch, stripped, table, text_of, without_lines,
    words_of, written,
)

#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
#: A line in more documents of a host than both is boilerplate; a document needs so many words left.
LINE_LIMIT, HOST_PERCENT, MIN_LEFT_PERCENT = 10, 1, 20


def _apart(docs: DataFrame, **read: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns ``read`` (name here by name there) and all others under names
    that nothing here uses, and these names by column."""
    here = {there: name for name, there in read.items()}
    names = {c: here.get(c, f"own_column_{i}") for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items())), names


def _back(names: dict[str, str], *results: str) -> list[Column]:
    """The columns of ``_apart`` under their own names, without those that ``results`` replace."""
    return [F.col(name).alias(c) for c, name in names.items() if c.lower() not in results]


def _windows(words: Column) -> Column:
    """A hash for every window of five words."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)),
    )


def _covered(windows: Column) -> Column:
    """Words covered by windows that come at least twice."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(placed: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            beside = [F.get(placed, k + step)["h"] == x["h"] for step in (-1, 1)]
            return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(placed, twin), lambda x: x["i"]))

    def total(starts: Column) -> Column:
        # A window covers five words, or those up to the next repeated window's start.
        steps = F.transform(
            starts, lambda i, k: F.least(F.coalesce(F.get(starts, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0), lambda n, step: n + step)

    return let(let(placed, starts), total)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that the text has at least twice."""

    def measure(windows: Column) -> Column:
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, _covered(windows)).otherwise(0)

    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(let(_windows(words), measure))


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(lines_of(text), lambda line: stripped(line) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics of ``STATS`` and ``base_failed``."""
    rows, names = _apart(docs, text="text")
    return _measured(rows).select(*_back(names, *STATS, "base_failed"), *STATS, "base_failed")


def _measured(rows: DataFrame) -> DataFrame:
    text = text_of()
    symbols = F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))
    measures = {
        "n_words": F.col("of_words.n"),
        "word_chars": F.col("of_words.chars"),
        "n_symbols": symbols,
        "n_dup_lines": _dup_lines(text),
        "n_repeat_words": F.col("of_words.repeated"),
    }
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.char_length(F.array_join(w, "")).alias("chars"),
            _repeat_words(w).alias("repeated"),
        ),
    )
    return rows.select("*", of_words.alias("of_words")).select(
        *rows.columns,
        *(column.cast("long").alias(name) for name, column in measures.items()),
    ).withColumn("base_failed", failed)


def _lines(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, text_hash, host, pos, h1, h2, words) of every line with a word."""
    h1, h2 = hash_pair(F.col("key"))
    return (
        docs.select(
            "doc_id",
            F.xxhash64(text_of()).alias("text_hash"),
            F.col(host).alias("host"),
            F.posexplode(lines_of(lower_ascii(text_of()))).alias("pos", "line"),
        )
        .select("doc_id", "text_hash", "host", "pos", stripped(F.col("line")).alias("key"))
        .where(F.col("key") != "")
        .select(
            "doc_id", "text_hash", "host", "pos", h1.alias("h1"), h2.alias("h2"),
            F.size(F.split("key", SPACE_RUN)).alias("words"),
        )
    )


def boilerplate(
    docs: DataFrame, host: str = "source", line_limit: int = LINE_LIMIT, host_percent: int = HOST_PERCENT,
    copies_count: bool = True,
) -> DataFrame:
    """(b_id, b_hash, b_host, gone, gone_words): a document's lines that too many documents of
    its host hold, by position, and the words in them."""
    lines = _lines(docs, host)
    holder = F.col("text_hash")
    if copies_count:
        holder = F.when(F.col("doc_id").isNull(), holder).otherwise(F.xxhash64("doc_id"))
    hosts = docs.groupBy(F.col(host).alias("t_host")).agg(
        (F.count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull())).alias("total")
    )
    frequent = (
        lines.groupBy("host", "h1", "h2")
        .agg(F.count_distinct(holder).alias("n_docs"))
        .where(F.col("n_docs") > line_limit)
        .join(hosts, F.col("host").eqNullSafe(F.col("t_host")))
        .where(100 * F.col("n_docs") > host_percent * F.col("total"))
        .select(F.col("host").alias("f_host"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
    )
    # A table, not an aggregate, beside the join: then a hot line's partition may be split.
    frequent = written(frequent, scratch(docs.sparkSession, "frequent-lines"))
    same = (
        (F.col("h1") == F.col("f1"))
        & (F.col("h2") == F.col("f2"))
        & F.col("host").eqNullSafe(F.col("f_host"))
    )
    # A set: a repeated row brings its twin's lines once more.
    found = F.sort_array(F.collect_set(F.struct("pos", "words")))
    return (
        lines.join(frequent, same)
        .groupBy(
            F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"), F.col("host").alias("b_host")
        )
        .agg(found.alias("found"))
        .select(
            "b_id", "b_hash", "b_host",
            F.col("found.pos").alias("gone"),
            F.aggregate("found.words", F.lit(0), lambda n, w: n + w).cast("long").alias("gone_words"),
        )
    )


def judge(
    docs: DataFrame, host: str = "source", line_limit: int = LINE_LIMIT, host_percent: int = HOST_PERCENT,
    min_left_percent: int = MIN_LEFT_PERCENT, copies_count: bool = True,
) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``n_boilerplate_words``,
    ``clean_text`` (the text without boilerplate lines) and ``kept``."""
    apart, names = _apart(docs, doc_id="doc_id", text="text", host=host)
    rows = _measured(apart).withColumn("own_hash", F.xxhash64(text_of()))
    gone = boilerplate(apart, "host", line_limit, host_percent, copies_count)
    same = (
        F.col("doc_id").eqNullSafe(F.col("b_id"))
        & (F.col("own_hash") == F.col("b_hash"))
        & F.col("host").eqNullSafe(F.col("b_host"))
    )
    words = F.coalesce("gone_words", F.lit(0).cast("long"))
    enough = 100 * (F.col("n_words") - words) >= min_left_percent * F.col("n_words")
    results = (*STATS, "base_failed", "n_boilerplate_words", "clean_text", "kept")
    judged = rows.join(gone, same, "left").select(
        *rows.columns,
        words.alias("n_boilerplate_words"),
        without_lines(text_of(), F.col("gone")).alias("clean_text"),
        (~F.col("base_failed") & enough).alias("kept"),
    )
    # Names come back in a step of their own: beside expressions they would be taken for columns read.
    return judged.select(*_back(names, *results), *results)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", *STATS, "base_failed", "n_boilerplate_words", "kept")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
line AS (
  SELECT doc_id, source, hash(text) AS t, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM d)),
full_line AS (SELECT * FROM line WHERE key <> ''),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_line GROUP BY doc_id),
counted AS (
  SELECT source, key, count(DISTINCT coalesce(doc_id::VARCHAR, 'text ' || t)) AS n
  FROM full_line GROUP BY source, key),
host AS (
  SELECT source, count(DISTINCT doc_id) + count(*) FILTER (WHERE doc_id IS NULL) AS total
  FROM d GROUP BY source),
frequent AS (
  SELECT c.source, key FROM counted c JOIN host h ON c.source IS NOT DISTINCT FROM h.source
  WHERE n > {LINE_LIMIT} AND 100 * n > {HOST_PERCENT} * total),
gone AS (
  SELECT l.doc_id, sum(len(list_filter(regexp_split_to_array(l.key, '[ \t-\r]+'), lambda w: w <> ''))) AS n
  FROM full_line l JOIN frequent f
    ON l.key = f.key AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.doc_id),
stat AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS gone_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       gone_words AS n_boilerplate_words,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND 100 * (n_words - gone_words) >= {MIN_LEFT_PERCENT} * n_words AS kept
FROM stat
"""
