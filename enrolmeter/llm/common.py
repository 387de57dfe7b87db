"""What several corpus operators share: text normalisation, hashing, written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract, and the letters A-Z.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[ \\t-\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is.

    ``lower`` does that to pure ASCII and is much the faster; it would also change other
    alphabets, so text beyond ASCII goes through ``translate``.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def lines_of(text: Column) -> Column:
    """The parts between newlines; empty text is one empty line."""
    return F.split(text, "\n", -1)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda is otherwise computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def without_lines(text: Column, dropped: Column) -> Column:
    """The text without the lines at the positions ``dropped`` (ascending; null: none).

    Takes the stretches between dropped positions, so it is linear however many there are.
    """
    after = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))

    def kept(lines: Column) -> Column:
        until = F.concat(dropped, F.array(F.size(lines)))
        stretches = F.zip_with(after, until, lambda a, u: F.slice(lines, a + 1, u - a))
        return F.array_join(F.flatten(stretches), "\n")

    return F.when(dropped.isNull(), text).otherwise(let(lines_of(text), kept))


def words_of(text: Column) -> Column:
    """Runs of anything but the six white-space characters; an empty array without any."""
    inner = stripped(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def hash_pair(*columns: Column) -> tuple[Column, Column]:
    """128 bits in two longs: a collision among 10^12 values has a chance near 10^-15."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(0x9E3779B97F4A7C15 - 2**64), *columns)


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables written between jobs, shared by all executors.

    It lies in ``spark.checkpoint.dir``, else in the checkpoint directory that the session was
    given by call. Without either it is a temporary folder of this machine in a local session,
    and an error on a cluster, whose executors could not see each other's files. Its tables back
    DataFrames that are still lazy, so the owner of the session clears the folder, not the operator.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share ({master=})")
        root = "file://" + tempfile.mkdtemp(prefix="enrolmeter-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write as Parquet and read back: lineage ends here and survives lost executors."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` other than ``names``, quoted for ``select``."""
    dropped = {n.lower() for n in names}
    return [f"`{c}`" for c in df.columns if c.lower() not in dropped]
