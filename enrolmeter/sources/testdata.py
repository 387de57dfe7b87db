"""The twelve logical tables derived from the TPC-H-like test files (FIXTURES.md, part 2).

Every row comes from the given files, so all tables grow with them. Two tables are
residue classes of the part key: at most 22 and 135 rows whatever the size of ``part``.
Spark cannot see that bound (it estimates a DISTINCT by its input), so these two, and only
these, carry a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import SCHEMAS, conform

# --- fixed values: how test keys map to ids (FIXTURES.md, part 2) ------------------------
SITE_OVERRIDES = {0: 49, 6: 39, 12: 11, 18: 12, 24: 13, 30: 47, 36: 81, 42: 9, 48: 10}
INSTITUTIONS = {0: 9, 1: 49, 2: 301, 3: 307}
INSTITUTION_NAMES = ((9, "INST-A"), (49, None), (301, "INST-C"), (307, "INST-D"))
GROUP_CATEGORIES = {0: 1, 1: 2, 2: 8, 3: 9, 4: 10, 5: 12, 6: 13, 7: 14, 8: 34, 9: 35, 10: 18}
CATEGORY_NAMES = {1: "Esam Cursos", 2: "Curso Modular"}
CHARGE_PLANS = ((1, "Plan Contado"), (2, "Plan Credito"), (3, "contado especial"), (4, None))
PRIORITIES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}
CONCEPTS = {0: 1, 1: 2, 2: 8, 3: 17, 4: 18, 5: 27, 6: 133, 7: 311, 8: 312}
GROUPS, SITES = 22, 135
ADVISER_BASE, RECEIPT_BASE = 1_000_000, 500_000
STUDENT_DOC_BASE, ADVISER_DOC_BASE = 3_000_000, 5_000_000

# Columns read from the given files. Stating them saves a footer-reading job per file.
_GIVEN = {
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, "
    "l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
}


def _decode(key: str, mapping: dict, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {code!r} THEN {value!r}" for code, value in mapping.items())
    return f"CASE {key} {arms} ELSE {otherwise} END"


class DerivedTables(Mapping):
    """Logical tables by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            if table not in SCHEMAS:
                raise KeyError(table)
            self._built[table] = conform(getattr(self, f"_{table}")(), table)
        return self._built[table]

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(_GIVEN[name]).parquet(f"{self._dir}/{name}.parquet")

    def _rows_in(self, name: str) -> Column:
        return self._read(name).agg(F.count(F.lit(1))).scalar()

    def _residues(self, modulus: int) -> DataFrame:
        """Residue classes of the part key: never more than ``modulus`` rows."""
        return F.broadcast(self._read("part").selectExpr(f"p_partkey % {modulus} AS id").distinct())

    def _inscripciones(self) -> DataFrame:
        order = F.col("o_orderkey")
        return (
            self._read("orders")
            .withColumns(
                {
                    "idprograma": order % self._rows_in("part"),
                    "adviser": order % self._rows_in("supplier"),
                }
            )
            .selectExpr(
                "o_orderkey AS id",
                "idprograma",
                "o_custkey AS idestudiante",
                f"IF(o_orderkey % 7 = 0, NULL, {ADVISER_BASE} + adviser) AS idasesor",
                f"{_decode('o_orderpriority', PRIORITIES)} AS plan_cobro_programa_id",
                "o_orderkey % 7 AS estado_ins",
                "o_orderdate AS created_at",
            )
        )

    def _programas(self) -> DataFrame:
        site = _decode("p_partkey % 54", SITE_OVERRIDES, f"p_partkey % {SITES}")
        partner = _decode("p_partkey % 4", INSTITUTIONS)
        return self._read("part").selectExpr(
            "p_partkey AS id",
            "'PRG-' || CAST(p_partkey AS STRING) AS codigo",
            "IF(p_size % 3 = 0, 'Curso ', 'Programa ') || p_name AS nombre_compuesto",
            f"p_partkey % {GROUPS} AS idpostgrado",
            f"{site} AS idsede",
            f"IF(p_partkey % 13 = 0, NULL, {partner}) AS iduniversidad",
        )

    def _postgrados(self) -> DataFrame:
        category = _decode("id % 11", GROUP_CATEGORIES)
        return self._residues(GROUPS).selectExpr("id", f"{category} AS idcategoria")

    def _categorias(self) -> DataFrame:
        rows = [(c, CATEGORY_NAMES.get(c, f"Categoria {c}")) for c in GROUP_CATEGORIES.values()]
        return _literal_rows(self._spark, rows, "categorias")

    def _plan_cobros_programa(self) -> DataFrame:
        return _literal_rows(self._spark, CHARGE_PLANS, "plan_cobros_programa")

    def _plan_pagos(self) -> DataFrame:
        """One instalment per (order, line number); repeated lines add up, in whole cents."""
        concept = _decode("(l_orderkey + l_linenumber % 6) % 9", CONCEPTS)
        return (
            self._read("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.expr("sum(CAST(rint(l_extendedprice * 100) AS BIGINT)) AS cents"))
            .selectExpr(
                "l_orderkey * 10 + l_linenumber AS id",
                "l_orderkey AS inscripcion_id",
                "IF(l_linenumber = 6, 2, 1) AS nro_cuota",
                f"{concept} AS concepto_pago_id",
                "CAST(CAST(cents AS DECIMAL(20, 0)) * 0.01BD AS DECIMAL(18, 2)) AS monto",
                "l_orderkey + l_linenumber AS k",
            )
            .selectExpr(
                "*",
                "CASE WHEN k % 97 = 0 THEN NULL WHEN k % 5 = 0 THEN monto "
                "WHEN k % 5 = 1 THEN 100 ELSE 0 END AS saldo",
            )
        )

    def _detalle_pagos_inscripcion(self) -> DataFrame:
        return (
            self._read("lineitem")
            .where("(l_orderkey + l_linenumber) % 5 <> 0")
            .selectExpr(
                "l_orderkey * 10 + l_linenumber AS cuota_id",
                "l_orderkey AS pagos_inscripcion_id",
                "l_shipdate AS fecha_registro_pago",
                "IF(l_returnflag = 'R', 0, 1) AS estado",
            )
        )

    def _pagos_inscripcion(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey AS id",
            f"o_orderkey + {RECEIPT_BASE} AS nro_recibo",
            "IF(o_orderstatus = 'P', 0, 1) AS estado",
        )

    def _personas(self) -> DataFrame:
        students = self._read("customer").selectExpr(
            "c_custkey AS id",
            "'Customer' AS nombres",
            "substr(c_name, 10) AS pri_apellido",
            "IF(c_custkey % 3 = 0, NULL, c_mktsegment) AS seg_apellido",
            f"CAST({STUDENT_DOC_BASE} + c_custkey AS STRING) AS num_doc",
        )
        advisers = self._read("supplier").selectExpr(
            f"{ADVISER_BASE} + s_suppkey AS id",
            "'Supplier' AS nombres",
            "substr(s_name, 10) AS pri_apellido",
            "CAST(NULL AS STRING) AS seg_apellido",
            f"CAST({ADVISER_DOC_BASE} + s_suppkey AS STRING) AS num_doc",
        )
        return students.unionAll(advisers)

    def _sedes(self) -> DataFrame:
        return self._residues(SITES).selectExpr(
            "id",
            "'SEDE ' || CAST(id AS STRING) AS nombre",
            "IF(id % 17 = 0, NULL, id % 5) AS unidad_negocio",
        )

    def _unidad_negocio(self) -> DataFrame:
        return self._read("region").selectExpr("r_regionkey AS id", "r_name AS nombre")

    def _instituciones(self) -> DataFrame:
        return _literal_rows(self._spark, INSTITUTION_NAMES, "instituciones")


def derived_tables(spark: SparkSession, sf_dir: str) -> DerivedTables:
    return DerivedTables(spark, sf_dir)


def _literal_rows(spark: SparkSession, rows, table: str) -> DataFrame:
    """A literal (id, text) table; VALUES gives Spark its exact size, so no hint is needed."""
    values = ", ".join(f"({i}, {'NULL' if text is None else repr(text)})" for i, text in rows)
    return spark.sql(f"SELECT * FROM VALUES {values}").toDF(*SCHEMAS[table].names)
