"""Chat formatting: one rendering of each dialogue per participant, in that one's place.

For every participant of a conversation the dialogue is rendered with that speaker as
``assistant``, all others as named users and system messages as they are, together with the
mask: the code-point ranges of the text on which that speaker's model is trained (each own
message and the end marker after it).

A dialogue is rendered in parts of ``part_turns`` turns, the part being ``turn div part_turns``:
an ordinary conversation is one part, and one with a third of all messages is many rows instead
of one that no executor could hold. Turns may repeat, so a part with more than ``part_messages``
messages is dealt into pieces, each turn of it into as many as that bound asks for, by ranges of
a hash that also orders the messages of a turn. Rows in the order of (part, piece) joined by
nothing make up the whole dialogue, masks shifted by the lengths before; no message is cut. A
speaker with no message in a piece has an empty mask there. Messages are counted per part by
partial aggregates, and the count meets them in a join whose hot side may be split.

Defined cases: a null role is the participant ``unknown``, null text is empty. A repeated row
(same conversation, turn, role and text) is one message. Messages of one turn are ordered by
their hash, then role and text. Messages without a turn have no place: they form a part of
their own (``untimed``), dealt into pieces like any other. A null ``conv_id`` is a
conversation of its own. A conversation of system messages only has no participant and no
rendering. Marker strings inside a message lose their bars, so that no text can open a turn.
Extra columns are not part of a dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

#: The markers of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"
PART_TURNS = 64
PART_MESSAGES = 1024
#: The hash that orders a turn's messages: so many hex digits, hence numbers.
HEX, NUMBERS = 8, 16**8


def _safe(text: Column) -> Column:
    for marker in (OPEN, CLOSE):
        text = F.replace(text, F.lit(marker), F.lit(marker.replace("|", "")))
    return text


def _messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of every different message, rendered safely."""
    role = F.coalesce(F.col("role"), F.lit(UNKNOWN))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _safe(F.replace(role, F.lit("\n"), F.lit(" "))).alias("role"),
        _safe(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    ).distinct()


def _placed(messages: DataFrame, part_turns: int, part_messages: int) -> DataFrame:
    """``messages`` with ``untimed``, ``part``, ``piece`` and ``hash``, which orders a turn."""
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(0)).cast("long")
    digits = F.substring(F.md5(F.concat("role", F.lit("\n"), "text").cast("binary")), 1, HEX)
    rows = messages.select(
        "*", F.col("turn").isNull().alias("untimed"), part.alias("part"),
        F.conv(digits, 16, 10).cast("long").alias("hash"),
    )
    crowded = (
        rows.groupBy(F.col("conv_id").alias("c_conv"), F.col("untimed").alias("c_untimed"), F.col("part").alias("c_part"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > part_messages)
        .withColumn("slices", F.ceil(F.col("n") / part_messages))
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("c_conv"))
        & (F.col("untimed") == F.col("c_untimed"))
        & (F.col("part") == F.col("c_part"))
    )
    turn_of_part = F.coalesce(F.col("turn") - F.col("part") * part_turns, F.lit(0))
    piece = turn_of_part * F.col("slices") + F.floor(F.col("hash") * F.col("slices") / NUMBERS)
    return rows.join(crowded, same, "left").select(
        *rows.columns, F.coalesce(piece, F.lit(0)).cast("long").alias("piece")
    )


def _segment(message: Column, speaker: Column) -> Column:
    """Head and body of one message, and whether it is trained on."""
    own = message["role"] == speaker
    name = F.when(own, "assistant").when(message["role"] == SYSTEM, SYSTEM)
    name = name.otherwise(F.concat(F.lit("user name="), message["role"]))
    return F.struct(
        F.concat(F.lit(OPEN), name, F.lit("\n")).alias("head"),
        F.concat(message["text"], F.lit(CLOSE)).alias("body"),
        own.alias("own"),
    )


def _mask(segments: Column) -> Column:
    """The trained ranges of the rendered text."""
    start = F.expr("struct(0 AS at, CAST(array() AS array<struct<start:int,end:int>>) AS spans)")

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + F.char_length(s["head"])
        end = begin + F.char_length(s["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(s["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(segments, start, step, lambda acc: acc["spans"])


def rotate(
    conversations: DataFrame, part_turns: int = PART_TURNS, part_messages: int = PART_MESSAGES
) -> DataFrame:
    """(conv_id, speaker, untimed, part, piece, n_messages, rendered, mask)."""
    messages = _messages(conversations)
    parts = _placed(messages, part_turns, part_messages).groupBy("conv_id", "untimed", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct("turn", "hash", "role", "text"))).alias("messages")
    )
    speakers = (
        messages.where(F.col("role") != SYSTEM)
        .select(F.col("conv_id").alias("of_conv"), F.col("role").alias("speaker"))
        .distinct()
    )
    segments = F.transform("messages", lambda m: _segment(m, F.col("speaker")))
    shown = let(
        segments,
        lambda all_of: F.struct(
            F.array_join(
                F.transform(all_of, lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), ""
            ).alias("rendered"),
            _mask(all_of).alias("mask"),
        ),
    )
    return (
        parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
        .select(
            "conv_id", "speaker", "untimed", "part", "piece",
            F.size("messages").cast("long").alias("n_messages"), shown.alias("shown"),
        )
        .select("conv_id", "speaker", "untimed", "part", "piece", "n_messages", "shown.rendered", "shown.mask")
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(ranges, ","))


ORACLE = rf"""
WITH m AS (
  SELECT *, ('0x' || substr(md5(role || chr(10) || text), 1, {HEX}))::BIGINT AS hash
  FROM (
    SELECT DISTINCT conv_id, turn, replace(coalesce(role, '{UNKNOWN}'), chr(10), ' ') AS role,
           replace(replace(coalesce(text, ''), '{OPEN}', '<im_start>'), '{CLOSE}', '<im_end>') AS text
    FROM conversations)),
p AS (
  SELECT *, turn IS NULL AS untimed, coalesce(turn // {PART_TURNS}, 0)::BIGINT AS part,
         count(*) OVER (PARTITION BY conv_id, turn IS NULL, coalesce(turn // {PART_TURNS}, 0)) AS n
  FROM m),
q AS (
  SELECT *, CASE WHEN n <= {PART_MESSAGES} THEN 0
                 ELSE coalesce(turn - part * {PART_TURNS}, 0) * ((n + {PART_MESSAGES} - 1) // {PART_MESSAGES})
                      + (hash * ((n + {PART_MESSAGES} - 1) // {PART_MESSAGES})) // {NUMBERS} END::BIGINT AS piece
  FROM p),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> '{SYSTEM}'),
seg AS (
  SELECT q.conv_id, speaker, untimed, part, piece, turn, hash, role, text, role = speaker AS own,
         '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM}' THEN '{SYSTEM}'
                          ELSE 'user name=' || role END || chr(10) AS head,
         text || '{CLOSE}' AS body
  FROM q JOIN s ON q.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, speaker, untimed, part, piece ORDER BY turn, hash, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS begin_at
  FROM seg)
SELECT conv_id, speaker, untimed, part, piece, count(*)::BIGINT AS n_messages,
       string_agg(head || body || chr(10), '' ORDER BY turn, hash, role, text) AS rendered,
       coalesce(string_agg(begin_at || '-' || (begin_at + length(body)), ',' ORDER BY turn, hash, role, text)
                FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, speaker, untimed, part, piece
"""
