"""Corpus queries against their plain SQL on DuckDB, and on empty tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from enrolmeter.llm.registry import ORACLES, QUERIES

from ..conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    actual = Counter(tuple(r) for r in df.select(*(f"`{n}`" for n in names)).collect())
    assert actual == Counter(result.fetchall()) and actual


def test_thirteen_queries_in_order():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "embeddings", "conversations", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_empty_results(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []
