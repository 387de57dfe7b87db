"""Reports over data where one enrolment holds a third of all lines, against plain SQL."""

import shutil
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from enrolmeter.plans.registry import QUERIES
from enrolmeter.sources.testdata import derived_tables

from .conftest import SMALL

GIVEN = ("region", "customer", "supplier", "part", "orders")


@pytest.mark.parametrize(
    "name", ["report_postgraduate", "report_partner_universities", "report_initial_fee"]
)
def test_hot_enrolment_changes_nothing(spark, conf, tmp_path, name):
    shown = QUERIES[name](derived_tables(spark, SMALL)).select("ID_INSCRIPCION").collect()
    for table in GIVEN:
        shutil.copy(f"{SMALL}/{table}.parquet", tmp_path)
    duck = duckdb.connect()
    busy = duck.execute(
        f"""SELECT l_orderkey FROM '{SMALL}/lineitem.parquet' GROUP BY l_orderkey
            HAVING l_orderkey IN {tuple(row[0] for row in shown)}
               AND min(l_shipdate) >= '1996-01-01' AND max(l_shipdate) <= '2000-12-31'
            ORDER BY count(*) DESC, l_orderkey LIMIT 1"""
    ).fetchone()[0]  # all its payments lie in the period, so its copies stay in the report
    duck.execute(
        f"""COPY (SELECT * FROM '{SMALL}/lineitem.parquet' UNION ALL
                  SELECT l.* REPLACE (CAST(1 + n % 7 AS INTEGER) AS l_linenumber,
                                      l_extendedprice + n AS l_extendedprice)
                  FROM '{SMALL}/lineitem.parquet' AS l, range(3000) AS copies(n)
                  WHERE l.l_orderkey = {busy})
            TO '{tmp_path}/lineitem.parquet'"""
    )
    for file in Path(tmp_path).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    share = duck.execute(f"SELECT avg((l_orderkey = {busy})::INT) FROM lineitem").fetchone()[0]
    assert share > 0.3

    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    df = entry.queries()[name](spark, str(tmp_path))
    result = duck.execute(entry.oracle_sql()[name])
    assert [c[0] for c in result.description] == df.columns
    expected = result.fetchall()
    assert busy in {row[df.columns.index("ID_INSCRIPCION")] for row in expected}
    assert Counter(map(tuple, df.collect())) == Counter(expected)
