"""The twelve logical tables over the given files, as common table expressions."""

from __future__ import annotations


def _case(key: str, pairs: dict, otherwise: str | None = None) -> str:
    arms = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in pairs.items())
    return f"CASE {key} {arms}{'' if otherwise is None else f' ELSE {otherwise}'} END"


SITE_OVERRIDES = {0: 49, 6: 39, 12: 11, 18: 12, 24: 13, 30: 47, 36: 81, 42: 9, 48: 10}
CATEGORY_OF_GROUP = {0: 1, 1: 2, 2: 8, 3: 9, 4: 10, 5: 12, 6: 13, 7: 14, 8: 34, 9: 35, 10: 18}
CONCEPT_OF_LINE = {0: 1, 1: 2, 2: 8, 3: 17, 4: 18, 5: 27, 6: 133, 7: 311, 8: 312}
PLAN_OF_PRIORITY = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}

TABLES: dict[str, str] = {
    "inscripciones": f"""
        SELECT o_orderkey AS id,
               o_orderkey % (SELECT count(*) FROM part) AS idprograma,
               o_custkey AS idestudiante,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE 1000000 + o_orderkey % (SELECT count(*) FROM supplier) END AS idasesor,
               CAST({_case("o_orderpriority", PLAN_OF_PRIORITY)} AS BIGINT) AS plan_cobro_programa_id,
               CAST(o_orderkey % 7 AS INTEGER) AS estado_ins,
               o_orderdate AS created_at
        FROM orders""",
    "programas": f"""
        SELECT p_partkey AS id,
               'PRG-' || CAST(p_partkey AS STRING) AS codigo,
               CASE WHEN p_size % 3 = 0 THEN 'Curso ' ELSE 'Programa ' END || p_name AS nombre_compuesto,
               p_partkey % 22 AS idpostgrado,
               CAST({_case("p_partkey % 54", SITE_OVERRIDES, "p_partkey % 135")} AS BIGINT) AS idsede,
               CAST(CASE WHEN p_partkey % 13 = 0 THEN NULL
                         ELSE {_case("p_partkey % 4", {0: 9, 1: 49, 2: 301, 3: 307})} END AS BIGINT)
                   AS iduniversidad
        FROM part""",
    "postgrados": f"""
        SELECT id, CAST({_case("id % 11", CATEGORY_OF_GROUP)} AS BIGINT) AS idcategoria
        FROM (SELECT DISTINCT p_partkey % 22 AS id FROM part) AS residues""",
    "categorias": """
        SELECT CAST(id AS BIGINT) AS id, nombre
        FROM (VALUES (1, 'Esam Cursos'), (2, 'Curso Modular'), (8, 'Categoria 8'),
                     (9, 'Categoria 9'), (10, 'Categoria 10'), (12, 'Categoria 12'),
                     (13, 'Categoria 13'), (14, 'Categoria 14'), (18, 'Categoria 18'),
                     (34, 'Categoria 34'), (35, 'Categoria 35')) AS v(id, nombre)""",
    "plan_cobros_programa": """
        SELECT CAST(id AS BIGINT) AS id, nombre
        FROM (VALUES (1, 'Plan Contado'), (2, 'Plan Credito'), (3, 'contado especial'),
                     (4, NULL)) AS v(id, nombre)""",
    "plan_pagos": f"""
        SELECT id, inscripcion_id, nro_cuota, concepto_pago_id, monto,
               CAST(CASE WHEN k % 97 = 0 THEN NULL WHEN k % 5 = 0 THEN monto
                         WHEN k % 5 = 1 THEN 100 ELSE 0 END AS DECIMAL(12, 2)) AS saldo
        FROM (SELECT l_orderkey * 10 + l_linenumber AS id,
                     l_orderkey AS inscripcion_id,
                     CASE WHEN l_linenumber = 6 THEN 2 ELSE 1 END AS nro_cuota,
                     {_case("(l_orderkey + l_linenumber % 6) % 9", CONCEPT_OF_LINE)} AS concepto_pago_id,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DECIMAL(12, 2)) AS monto,
                     l_orderkey + l_linenumber AS k
              FROM lineitem GROUP BY l_orderkey, l_linenumber) AS summed""",
    "detalle_pagos_inscripcion": """
        SELECT l_orderkey * 10 + l_linenumber AS cuota_id,
               l_orderkey AS pagos_inscripcion_id,
               l_shipdate AS fecha_registro_pago,
               CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS estado
        FROM lineitem WHERE (l_orderkey + l_linenumber) % 5 <> 0""",
    "pagos_inscripcion": """
        SELECT o_orderkey AS id, o_orderkey + 500000 AS nro_recibo,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS estado
        FROM orders""",
    "personas": """
        SELECT c_custkey AS id, 'Customer' AS nombres, substr(c_name, 10) AS pri_apellido,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg_apellido,
               CAST(3000000 + c_custkey AS STRING) AS num_doc
        FROM customer
        UNION ALL
        SELECT 1000000 + s_suppkey, 'Supplier', substr(s_name, 10), NULL,
               CAST(5000000 + s_suppkey AS STRING)
        FROM supplier""",
    "sedes": """
        SELECT id, 'SEDE ' || CAST(id AS STRING) AS nombre,
               CASE WHEN id % 17 = 0 THEN NULL ELSE id % 5 END AS unidad_negocio
        FROM (SELECT DISTINCT p_partkey % 135 AS id FROM part) AS residues""",
    "unidad_negocio": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS nombre FROM region""",
    "instituciones": """
        SELECT CAST(id AS BIGINT) AS id, abreviatura
        FROM (VALUES (9, 'INST-A'), (49, NULL), (301, 'INST-C'), (307, 'INST-D'))
             AS v(id, abreviatura)""",
}


def with_tables(body: str, **derived: str) -> str:
    """``body`` over the logical tables it or a derived table names, and those derived ones."""
    text = " ".join((body, *derived.values()))
    parts = {name: sql for name, sql in TABLES.items() if name in text} | derived
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\n{body}"
