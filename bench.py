"""Times the reports and prints one JSON line.

``queries`` holds the library's reports, ``as_written`` the same reports as plain SQL on the
same Spark session (one derived table per balance, payments joined row by row). Both read the
given files, derive the logical tables within the query and collect the result. All run once
to warm up, then ``BENCH_RUNS`` times in turn; the median counts. Both sides run under the same
session options; the one that spares call sites for error messages helps only plans built from
Python, so the library's side, by a few tenths of a second each.

``BENCH_COPIES=20`` first writes that many copies of orders, line items and customers with
shifted keys to a new temporary folder and reads from there (off by default).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrolmeter.plans.registry import QUERIES
from enrolmeter.sources.testdata import derived_tables
from oracle import oracle_queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
#: Keys of each copied table; all move together, so that copies stay consistent.
COPIED_KEYS = {"orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey",), "customer": ("c_custkey",)}
SHIFT = 10**9
GIVEN = ("region", "customer", "supplier", "part", "orders", "lineitem")


def seconds(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def copied(spark: SparkSession, folder: str) -> str:
    """The given tables with ``COPIES`` copies of the growing ones, in a folder of their own."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in GIVEN:
        df: DataFrame = spark.read.parquet(f"{folder}/{name}.parquet")
        if name in COPIED_KEYS:
            copies = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
            moved = {key: F.col(key) + F.col("copy") * F.lit(SHIFT).cast("long") for key in COPIED_KEYS[name]}
            df = copies.withColumns(moved).drop("copy")
        df.write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("enrolmeter-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Call sites for error messages cost more than building a plan does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = SF_DIR if COPIES == 1 else copied(spark, SF_DIR)
    for name in GIVEN:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)

    tables, plain = derived_tables(spark, folder), oracle_queries()
    names = [name for name in QUERIES if name.startswith("report_")]
    ours: dict[str, list[float]] = {name: [] for name in names}
    theirs: dict[str, list[float]] = {name: [] for name in names}
    for turn in range(RUNS + 1):
        for name in names:
            took = seconds(lambda: QUERIES[name](tables).collect())
            took_plain = seconds(lambda: spark.sql(plain[name]).collect())
            if turn:
                ours[name].append(took)
                theirs[name].append(took_plain)
    spark.stop()
    queries = {name: round(median(ours[name]), 3) for name in names}
    as_written = {name: round(median(theirs[name]), 3) for name in names}

    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "all reports, wall time",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "copies": COPIES,
                "as_written_total": round(sum(as_written.values()), 3),
                "as_written": as_written,
            }
        )
    )
    sys.stdout.flush()


if __name__ == "__main__":
    main()
