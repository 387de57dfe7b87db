"""What the plans must look like to hold at cluster scale, checked on physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from enrolmeter import UNITS, deduplicated, load_tables, report
from enrolmeter.operators.balances import Balance, enrolment_balances, payments_info
from enrolmeter.operators.star import attach_people
from enrolmeter.plans.registry import END, QUERIES, START
from enrolmeter.plans.report import _once_per_value
from enrolmeter.sources.testdata import derived_tables

from .conftest import SMALL
from .tiny import tables

DEDUP = [name for name, spec in UNITS.items() if {b.payments for b in spec.balances} & {"dedup"}]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The logical tables as files, the way a user keeps them."""
    home = str(tmp_path_factory.mktemp("tables"))
    for name, df in derived_tables(spark, SMALL).items():
        df.write.parquet(f"{home}/{name}")
    return load_tables(spark, home)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan adaptive execution ended with; reused exchanges do not repeat their input."""
    return physical(df).split("== Initial Plan ==")[0]


def scans(plan: str) -> list[set[str]]:
    found = re.findall(r"FileScan parquet .*?\[(.*?)\]", plan)
    return [{re.sub(r"#\d+L?", "", column) for column in scan.split(",")} for scan in found]


def scans_of(plan: str, marker: str) -> int:
    return sum(marker in columns for columns in scans(plan))


@pytest.mark.parametrize("name", QUERIES)
def test_no_pairwise_join_and_no_python(small_tables, name):
    plan = physical(QUERIES[name](small_tables))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in plan


@pytest.mark.parametrize("name", [*UNITS, "postgraduate_dedup"])
def test_each_fact_is_scanned_once(stored, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    spec = UNITS[name] if name in UNITS else deduplicated(UNITS["postgraduate"])
    df = report(stored, spec, START, END)
    df.collect()
    plan = executed(df)
    # Totals, values and enrolments without values read one and the same grouping.
    assert scans_of(plan, "inscripcion_id") == 1  # instalments
    assert scans_of(plan, "cuota_id") == 1  # payments
    assert scans_of(plan, "idprograma") == 1  # enrolments
    receipts = sum(columns == {"id", "estado"} for columns in scans(plan))
    assert receipts == (0 if name in UNITS and name not in DEDUP else 1)  # raw counts need none
    assert scans_of(plan, "nro_recibo") == 0


def test_filters_and_columns_reach_the_scans(stored, conf):
    conf(maxMetadataStringLength="1000")
    plan = physical(report(stored, UNITS["institute"], START, END))
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert any("EqualTo(concepto_pago_id,27)" in p and "EqualTo(nro_cuota,1)" in p for p in pushed)
    assert any("EqualTo(idsede,49)" in p for p in pushed)
    assert any("EqualTo(estado,1)" in p for p in pushed)
    assert scans_of(plan, "created_at") == 0


def test_site_and_partner_filters_on_joined_columns_reach_the_program_scan(stored, conf):
    conf(maxMetadataStringLength="1000")
    plan = physical(QUERIES["filter_institution"](stored))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan))
    assert "EqualTo(iduniversidad,49)" in pushed
    assert "LeftOuter" in plan  # the business unit stays optional
    assert len(re.findall("LeftOuter", plan)) == 1  # the partner join became inner


@pytest.mark.parametrize("name", UNITS)
def test_stored_tables_are_never_broadcast_by_force(stored, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    plan = physical(report(stored, UNITS[name], START, END))
    assert "BroadcastExchange" not in plan
    facts = re.findall(r"Exchange hashpartitioning\((?:id|cuota_id|pagos_inscripcion_id)#", plan)
    if UNITS[name].by_value is None:
        assert len(facts) == (4 if name in DEDUP else 2)


def test_unsorted_report_has_no_range_shuffle(stored):
    sorted_plan = physical(report(stored, UNITS["careers"], START, END))
    plain = physical(report(stored, UNITS["careers"], START, END, ordered=False))
    assert "rangepartitioning" in sorted_plan and "rangepartitioning" not in plain


def test_bucketed_facts_join_without_a_shuffle(spark, stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    own = {"plan_pagos": "inscripcion_id", "inscripciones": "id"}
    t = dict(stored)
    for name, key in own.items():
        stored[name].write.mode("overwrite").bucketBy(8, key).saveAsTable(f"bucketed_{name}")
        t[name] = spark.table(f"bucketed_{name}")
    try:
        joined = t["plan_pagos"].join(
            t["inscripciones"].withColumnRenamed("id", "inscripcion_id"), "inscripcion_id"
        )
        assert "Exchange" not in physical(joined)
        everywhere = enrolment_balances(t, Balance("plan", payments="none"))
        assert "Exchange" not in physical(everywhere)
    finally:
        for name in own:
            spark.sql(f"DROP TABLE bucketed_{name}")


def bucketed(spark, stored, **keys):
    """The stored tables, some of them bucketed by a key."""
    t = dict(stored)
    for name, key in keys.items():
        stored[name].write.mode("overwrite").bucketBy(8, key).saveAsTable(f"bucketed_{name}")
        t[name] = spark.table(f"bucketed_{name}")
    return t


def test_payments_by_instalment_spare_a_raw_report_their_shuffle(spark, stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    on_instalment = r"Exchange hashpartitioning\(cuota_id#"
    plain = physical(report(stored, UNITS["short_courses"], START, END))
    t = bucketed(spark, stored, detalle_pagos_inscripcion="cuota_id")
    try:
        placed = physical(report(t, UNITS["short_courses"], START, END))
        assert re.search(on_instalment, plain) and not re.search(on_instalment, placed)
    finally:
        spark.sql("DROP TABLE bucketed_detalle_pagos_inscripcion")


def test_payments_and_receipts_by_receipt_spare_a_deduplicated_report_two_shuffles(spark, stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    on_receipt = r"Exchange hashpartitioning\(pagos_inscripcion_id#"
    plain = physical(report(stored, UNITS["institute"], START, END))
    keys = {"detalle_pagos_inscripcion": "pagos_inscripcion_id", "pagos_inscripcion": "id"}
    t = bucketed(spark, stored, **keys)
    try:
        placed = physical(report(t, UNITS["institute"], START, END))
        assert len(re.findall(on_receipt, plain)) == 2 and not re.search(on_receipt, placed)
    finally:
        for name in keys:
            spark.sql(f"DROP TABLE bucketed_{name}")


# --- one key holds a third of the rows ------------------------------------------------------


@pytest.fixture
def small_skew(conf):
    """Skew thresholds small enough for test data; on a cluster the defaults apply."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4KB",
        adaptive__coalescePartitions__enabled="false",
    )


def splits(df) -> bool:
    df.collect()
    return "skew=true" in physical(df)


def hot(key: str, span: int = 997):
    """A third of the rows share key 1, the rest spread over ``span`` keys."""
    return F.expr(f"IF({key} % 3 = 0, 1L, 1 + {key} % {span})")


def test_hot_receipt_is_split(spark, small_skew):
    n = 60_000
    details = spark.range(0, n, 1, 8).select(
        F.col("id").alias("cuota_id"),
        hot("id").alias("pagos_inscripcion_id"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("fecha_registro_pago"),
        F.lit(1).alias("estado"),
    )
    receipts = spark.range(0, 1000, 1, 8).select(
        "id", (F.col("id") + 500).alias("nro_recibo"), F.lit(1).alias("estado")
    )
    info = payments_info(details, receipts)
    assert splits(info)
    assert info.count() == n


def test_hot_instalment_arrives_combined(spark):
    """A third of the payments on one instalment: each task sends one row for it."""
    details = spark.range(0, 60_000, 1, 8).select(
        hot("id").alias("cuota_id"),
        F.lit(1).cast("bigint").alias("pagos_inscripcion_id"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("fecha_registro_pago"),
        F.lit(1).alias("estado"),
    )
    t = tables(spark, plan_pagos=[]) | {"detalle_pagos_inscripcion": details}
    t["plan_pagos"] = spark.range(1, 998).selectExpr(
        "id", "100L + id % 2 AS inscripcion_id", "1 AS nro_cuota", "18 AS concepto_pago_id",
        "CAST(2 AS DECIMAL(18, 2)) AS monto", "CAST(0 AS DECIMAL(18, 2)) AS saldo",
    )
    balance = enrolment_balances(t, Balance("b", (18,), payments="raw"))
    assert "partial_count" in physical(balance)
    assert balance.agg(F.sum("b_monto")).first()[0] == 2 * 60_000


@pytest.mark.parametrize("adviser", ["1L", "CAST(NULL AS BIGINT)"])
def test_hot_or_absent_adviser_is_split(spark, small_skew, adviser):
    n = 60_000
    enrolments = spark.range(0, n, 1, 8).selectExpr(
        "id AS ID_INSCRIPCION",
        "id % 500 AS idestudiante",
        f"IF(id % 3 = 0, {adviser}, 1000 + id % 499) AS idasesor",
    )
    people = spark.range(0, 1600, 1, 8).selectExpr(
        "id", "'N' AS nombres", "CAST(id AS STRING) AS pri_apellido",
        "CAST(NULL AS STRING) AS seg_apellido", "'D' AS num_doc",
    )
    joined = attach_people(enrolments, {"personas": people})
    assert splits(joined)
    assert joined.count() == n
    named = joined.where("ASESOR = ''").count()
    assert named == (0 if adviser == "1L" else n // 3)


def test_enrolment_with_a_third_of_all_values_is_split(spark, small_skew):
    n = 60_000
    values = spark.range(0, n, 1, 8).select(
        hot("id").alias("ID_INSCRIPCION"), F.col("id").cast("decimal(28,2)").alias("b_monto")
    )
    rows = spark.range(0, 1200, 1, 8).selectExpr(
        "id AS ID_INSCRIPCION", "IF(id BETWEEN 1 AND 997, 1, 0) AS has_values"
    )
    spread = _once_per_value(rows, values)
    assert splits(spread)
    assert spread.where("b_monto IS NOT NULL").count() == n
    assert spread.where("b_monto IS NULL").count() == 1200 - 997
