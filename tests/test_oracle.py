"""Every registered query against its plain SQL on DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from enrolmeter.plans.registry import QUERIES as REPORT_QUERIES

from .conftest import SMALL

ORACLE = entry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in REPORT_QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(REPORT_QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    result = duck.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    expected = result.fetchall()

    assert sorted(df.columns) == sorted(names)
    order = [df.columns.index(n) for n in names]
    actual = [tuple(row[i] for i in order) for row in rows]
    assert Counter(actual) == Counter(expected)
    assert expected, "an empty result proves nothing"
    if name.startswith("report_"):
        assert df.columns == names
        assert actual == expected  # reports are sorted


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 90
