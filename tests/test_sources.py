import pytest
from pyspark.sql import functions as F

from enrolmeter import UNITS, catalog_tables, load_tables, report
from enrolmeter.sources.schema import ACADEMIC, FACTS, SCHEMAS, conform
from enrolmeter.sources.tables import jdbc_bounds_options, jdbc_options, jdbc_ranges, jdbc_tables

from .tiny import line, payment, tables

YEAR = ("2026-01-01 00:00:00", "2026-12-31 23:59:59")


@pytest.fixture
def paid(spark):
    return tables(
        spark,
        plan_pagos=[line(1, 100, 27, 300, 0)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03")],
    )


def test_files_give_the_same_report(spark, paid, tmp_path):
    for name, df in paid.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    stored = load_tables(spark, str(tmp_path), pattern="{location}/{table}.parquet")
    expected = report(paid, UNITS["institute"], *YEAR).collect()
    assert report(stored, UNITS["institute"], *YEAR).collect() == expected
    assert len(expected) == 1


def test_catalog_namespaces_give_the_same_report(spark, paid):
    homes = {name: "academic_test" if name in ACADEMIC else "admin_test" for name in SCHEMAS}
    try:
        for home in set(homes.values()):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {home}")
        for name, home in homes.items():
            paid[name].write.mode("overwrite").saveAsTable(f"{home}.{name}")
        stored = catalog_tables(spark, "academic_test", "admin_test")
        expected = report(paid, UNITS["institute"], *YEAR).collect()
        assert report(stored, UNITS["institute"], *YEAR).collect() == expected
    finally:
        for home in set(homes.values()):
            spark.sql(f"DROP DATABASE IF EXISTS {home} CASCADE")


def test_conform_casts_reorders_and_drops(spark):
    loose = spark.sql("SELECT 'x' AS extra, 8 AS idcategoria, '3' AS id")
    got = conform(loose, "postgrados")
    assert got.schema.simpleString() == "struct<id:bigint,idcategoria:bigint>"
    assert got.first() == (3, 8)


def test_moments_with_a_zone_become_local_ones(spark):
    zoned = spark.sql(
        "SELECT 1L cuota_id, 1L pagos_inscripcion_id, TIMESTAMP '2026-02-03 10:00:00' "
        "fecha_registro_pago, 1 estado"
    )
    got = conform(zoned, "detalle_pagos_inscripcion").select(
        F.col("fecha_registro_pago").cast("string")
    )
    assert got.first()[0] == "2026-02-03 10:00:00"


def test_ranged_reads_over_jdbc():
    whole = jdbc_options("sedes", "jdbc:x", "admin", None, 8)
    assert whole["dbtable"] == "admin.sedes" and "partitionColumn" not in whole
    ranged = jdbc_options("detalle_pagos_inscripcion", "jdbc:x", "academic", (1, 900), 8)
    assert ranged["partitionColumn"] == "cuota_id"
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("1", "900", "8")


def test_fact_tables_over_jdbc_need_a_range(spark):
    with pytest.raises(ValueError, match="ranges lacks .*plan_pagos, detalle_pagos_inscripcion"):
        jdbc_tables(spark, "jdbc:x", "academic", "admin", {"inscripciones": (1, 9)})


class Database:
    """Stands in for a session that reads over JDBC: answers with set rows, keeps the options."""

    def __init__(self, answers):
        self.answers, self.asked, self.read = iter(answers), [], self

    def format(self, name):
        assert name == "jdbc"
        self.asked.append({})
        return self

    def options(self, **settings):
        self.asked[-1].update(settings)
        return self

    def load(self):
        return self

    def first(self):
        return next(self.answers)


def test_bounds_are_found_by_the_database():
    assert jdbc_bounds_options("detalle_pagos_inscripcion", "jdbc:x", "academic") == {
        "url": "jdbc:x",
        "query": "SELECT min(cuota_id) AS lowest, max(cuota_id) AS highest FROM academic.detalle_pagos_inscripcion",
    }
    database = Database([(3, 90), (None, None), *[(1, 2)] * (len(FACTS) - 2)])
    ranges = jdbc_ranges(database, "jdbc:x", "academic", "admin", {"user": "reader"})
    assert list(ranges) == list(FACTS) and list(ranges.values())[:2] == [(3, 90), (0, 1)]
    assert all(asked["user"] == "reader" and "min(" in asked["query"] for asked in database.asked)
