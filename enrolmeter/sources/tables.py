"""Readers that return the twelve logical tables as ``{name: DataFrame}``.

No reader runs a query; ``jdbc_ranges``, which finds bounds for one, does. A Parquet load reads one footer for the schema, and schemaless formats
such as CSV are read through to infer theirs. No reader hints a broadcast: file and catalog sizes are known to
Spark, which broadcasts a table only below ``spark.sql.autoBroadcastJoinThreshold``, and
adaptive execution does the same at run time with measured sizes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .schema import ACADEMIC, ADMIN, FACTS, RANGE_COLUMN, SCHEMAS, conform

Tables = Mapping[str, DataFrame]


def load_tables(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    pattern: str = "{location}/{table}",
) -> dict[str, DataFrame]:
    """Tables stored as files, one path per table (``pattern`` places them)."""
    return {
        name: conform(
            spark.read.format(fmt).load(pattern.format(location=location, table=name)), name
        )
        for name in SCHEMAS
    }


def catalog_tables(spark: SparkSession, academic: str, admin: str) -> dict[str, DataFrame]:
    """Tables registered in the session catalog under two namespaces.

    Buckets spare shuffles. ``inscripciones`` by ``id`` and ``plan_pagos`` by
    ``inscripcion_id`` join in place. For payments, the largest tables, it depends on the
    report: with ``detalle_pagos_inscripcion`` by ``cuota_id`` a raw report groups payments in
    place; with it by ``pagos_inscripcion_id`` and ``pagos_inscripcion`` by ``id``, in equal
    numbers of buckets, a deduplicated one joins receipts in place.
    """
    homes = {**dict.fromkeys(ACADEMIC, academic), **dict.fromkeys(ADMIN, admin)}
    return {name: conform(spark.table(f"{home}.{name}"), name) for name, home in homes.items()}


def jdbc_tables(
    spark: SparkSession,
    url: str,
    academic: str,
    admin: str,
    ranges: Mapping[str, tuple[int, int]] | None = None,
    partitions: int = 64,
    options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Tables in a relational database with two schemas.

    ``ranges`` gives (lowest, highest) id for the tables that should be read in parallel;
    the bounds only decide the cut, rows outside them are still read. The four fact tables
    must have a range: without one a table goes through a single task. ``jdbc_ranges`` asks the
    database for them.

    A partition's rows must not gather in memory before the first is used. Drivers differ in
    when they stream: MySQL's heeds ``fetchsize`` only with ``useCursorFetch=true`` in the URL.
    """
    missing = [name for name in FACTS if name not in (ranges or {})]
    if missing:
        raise ValueError(f"ranges lacks (lowest, highest) id of {', '.join(missing)}")
    homes = {**dict.fromkeys(ACADEMIC, academic), **dict.fromkeys(ADMIN, admin)}
    out = {}
    for name, home in homes.items():
        settings = jdbc_options(name, url, home, (ranges or {}).get(name), partitions)
        reader = spark.read.format("jdbc").options(**settings).options(**(options or {}))
        out[name] = conform(reader.load(), name)
    return out


def jdbc_ranges(
    spark: SparkSession, url: str, academic: str, admin: str, options: Mapping[str, str] | None = None
) -> dict[str, tuple[int, int]]:
    """The (lowest, highest) id of every fact table, for ``jdbc_tables``.

    The database finds both, from its index where it has one, and returns one row a table.
    An empty table gets the range (0, 1).
    """
    homes = {**dict.fromkeys(ACADEMIC, academic), **dict.fromkeys(ADMIN, admin)}
    ranges = {}
    for name in FACTS:
        settings = jdbc_bounds_options(name, url, homes[name])
        row = spark.read.format("jdbc").options(**settings).options(**(options or {})).load().first()
        ranges[name] = (0, 1) if row is None or row[0] is None else (int(row[0]), int(row[1]))
    return ranges


def jdbc_bounds_options(table: str, url: str, schema: str) -> dict[str, str]:
    """Reader options for the lowest and highest value of a table's range column."""
    column = RANGE_COLUMN[table]
    query = f"SELECT min({column}) AS lowest, max({column}) AS highest FROM {schema}.{table}"
    return {"url": url, "query": query}


def jdbc_options(
    table: str, url: str, schema: str, bounds: tuple[int, int] | None, partitions: int
) -> dict[str, str]:
    """Reader options for one table, ranged when ``bounds`` are given."""
    settings = {"url": url, "dbtable": f"{schema}.{table}", "fetchsize": "10000"}
    if bounds is not None:
        settings |= {
            "partitionColumn": RANGE_COLUMN[table],
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return settings
