from datetime import datetime

import pytest

from enrolmeter import UNITS, deduplicated, report

from .tiny import at, enrolment, line, payment, tables

YEAR = ("2026-01-01 00:00:00", "2026-12-31 23:59:59")

COLUMNS = {
    "head": [
        "UNIDAD", "SEDE", "ASESOR", "CI_ASESOR", "ALUMNO", "CI_ALUMNO", "TIPO_PROGRAMA",
        "ID_INSCRIPCION", "COD_CONTABLE", "PROGRAMA", "ID_PROGRAMA",
    ],
    "verdict": ["FECHA_PAGO_DECISIVA", "CONDICION_INSCRITO", "ESTADO_INSCRIPCION"],
}


def collect(t, unit, *period):
    return report(t, UNITS[unit], *(period or YEAR)).collect()


def test_single_fee_report_row(spark):
    t = tables(
        spark,
        plan_pagos=[line(1, 100, 27, 300, 0), line(2, 100, 27, 300, 300, number=2)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03"), payment(1, 3, "2026-03-04")],
    )
    (row,) = collect(t, "institute")
    assert row.asDict() == {
        "UNIDAD": "UNIDAD 1", "SEDE": "SEDE 49", "ASESOR": "Luis  Paz", "CI_ASESOR": "CI20",
        "ALUMNO": "Ana Rojas", "CI_ALUMNO": "CI10", "TIPO_PROGRAMA": "Categoria 8",
        "ID_INSCRIPCION": 100, "COD_CONTABLE": "PRG-1", "PROGRAMA": "Programa uno",
        "ID_PROGRAMA": 1, "TIPO_PLAN_PAGO": "Contado", "MONTO_MENSUALIDAD_CUOTA1": 300,
        "CANCELADO_MENSUALIDAD_CUOTA1": 300, "SALDO_MENSUALIDAD_CUOTA1": 0,
        "FECHA_PAGO_DECISIVA": at("2026-03-04"), "CONDICION_INSCRITO": "INSCRITO",
        "ESTADO_INSCRIPCION": "INSCRITO", "CONVENIO": "INST-A", "MES": "MARZO",
    }


def test_absent_adviser_plan_state_and_unit(spark):
    t = tables(
        spark,
        inscripciones=[enrolment(100, adviser=None, plan=None, state=None)],
        sedes=[(49, "SEDE 49", None)],
        programas=[(1, "PRG-1", "Programa uno", 1, 49, None)],
        plan_pagos=[line(1, 100, 27, 300, None)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03")],
    )
    (row,) = collect(t, "institute")
    assert (row.ASESOR, row.CI_ASESOR, row.UNIDAD) == ("", None, None)
    assert (row.TIPO_PLAN_PAGO, row.ESTADO_INSCRIPCION) == ("Crédito", "NO IDENTIFICADO")
    assert (row.CONVENIO, row.CONDICION_INSCRITO) == ("Sin Convenio", "NO INSCRITO")
    assert (row.CANCELADO_MENSUALIDAD_CUOTA1, row.SALDO_MENSUALIDAD_CUOTA1) == (0, 0)


def test_absent_student_drops_the_enrolment(spark):
    t = tables(
        spark,
        inscripciones=[enrolment(100, student=77)],
        plan_pagos=[line(1, 100, 27, 300, 0)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03")],
    )
    assert collect(t, "institute") == []


def test_period_decides_by_the_last_payment(spark):
    t = tables(
        spark,
        inscripciones=[enrolment(i) for i in (100, 101, 102, 103)],
        plan_pagos=[line(i, 100 + i, 27, 300, 0) for i in range(4)],
        detalle_pagos_inscripcion=[
            payment(0, 1, "2026-01-01 00:00:00"),
            payment(1, 1, "2025-12-31 23:59:59"),
            payment(2, 1, "2026-12-31 23:59:59"),
            payment(3, 1, "2026-05-01"), payment(3, 1, "2027-01-01"),
        ],
    )
    rows = collect(t, "institute")
    assert [(r.ID_INSCRIPCION, r.MES) for r in rows] == [(100, "ENERO"), (102, "DICIEMBRE")]


def postgraduate_tables(spark, plan_pagos, payments, plan=2):
    return tables(
        spark,
        inscripciones=[enrolment(100, plan=plan)],
        programas=[(1, "PRG-1", "Programa uno", 1, 1, 9)],
        plan_pagos=plan_pagos,
        detalle_pagos_inscripcion=payments,
    )


def test_unlike_first_tuitions_repeat_the_enrolment(spark):
    t = postgraduate_tables(
        spark,
        [line(1, 100, 2, 50, 0), line(2, 100, 2, 60, 10), line(3, 100, 1, 5, 0)],
        [payment(1, 1, "2026-02-01"), payment(2, 1, "2026-01-15"), payment(3, 1, "2026-01-02")],
    )
    rows = collect(t, "postgraduate")
    got = [(r.MONTO_COLEGIATURA_CUOTA1, r.MES, r.CONDICION_INSCRITO) for r in rows]
    assert got == [(60, "ENERO", "NO INSCRITO"), (50, "FEBRERO", "INSCRITO")]  # by tuition date
    assert {r.MONTO_TOTAL_PLAN for r in rows} == {115}


def test_equal_first_tuitions_collapse(spark):
    t = postgraduate_tables(
        spark,
        [line(1, 100, 2, 50, 0), line(2, 100, 2, 50, 0)],
        [payment(1, 1, "2026-02-01"), payment(2, 1, "2026-03-15")],
    )
    (row,) = collect(t, "postgraduate")
    assert (row.MONTO_COLEGIATURA_CUOTA1, row.MES, row.MONTO_TOTAL_PLAN) == (50, "MARZO", 100)


def test_without_tuition_the_enrolment_fee_dates_it(spark):
    t = postgraduate_tables(spark, [line(3, 100, 1, 5, 0)], [payment(3, 1, "2026-01-02")])
    (row,) = collect(t, "postgraduate")
    assert (row.MES, row.CONDICION_INSCRITO) == ("ENERO", "NO INSCRITO")
    assert row.MONTO_COLEGIATURA_CUOTA1 == 0
    cash = postgraduate_tables(spark, [line(3, 100, 1, 5, 0)], [payment(3, 1, "2026-01-02")], plan=1)
    assert collect(cash, "postgraduate") == []


def test_category_outside_the_kids_lists_is_filtered_out(spark):
    t = tables(
        spark,
        programas=[(1, "PRG-1", "Programa uno", 1, 11, None)],
        postgrados=[(1, 18)],
        categorias=[(18, "Categoria 18")],
        plan_pagos=[line(1, 100, 27, 300, 0), line(2, 100, 311, 300, 0)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03"), payment(2, 1, "2026-02-03")],
    )
    assert collect(t, "kids") == []


def test_dedup_form_ignores_voided_receipts_and_repeated_payments(spark):
    t = tables(
        spark,
        programas=[(1, "PRG-1", "Curso uno", 1, 21, None)],
        sedes=[(21, "SEDE 21", 1)],
        plan_pagos=[line(1, 100, 18, 300, 0)],
        detalle_pagos_inscripcion=[
            payment(1, 1, "2026-02-03"), payment(1, 3, "2026-02-04"), payment(1, 2, "2026-03-03"),
        ],
    )
    (raw,) = collect(t, "short_courses")
    (dedup,) = report(t, deduplicated(UNITS["short_courses"]), *YEAR).collect()
    assert (raw.MONTO_TOTAL, raw.MES) == (900, "MARZO")
    assert (dedup.MONTO_TOTAL, dedup.MES) == (300, "FEBRERO")


@pytest.mark.parametrize(
    "unit, middle, tail",
    [
        ("postgraduate", ["TIPO_PLAN_PAGO", "ES_CURSO", "MONTO_MATRICULA", "SALDO_MATRICULA",
                          "MONTO_COLEGIATURA_CUOTA1", "SALDO_COLEGIATURA_CUOTA1",
                          "MONTO_TOTAL_PLAN", "SALDO_TOTAL_PLAN"],
         ["CONVENIO", "MES", "fecha_creacion_inscripcion"]),
        ("initial_fee", ["TIPO_PLAN_PAGO", "MONTO_CUOTA_INICIAL", "CANCELADO_CUOTA_INICIAL",
                         "SALDO_CUOTA_INICIAL", "MONTO_COLEGIATURA_INICIAL",
                         "CANCELADO_COLEGIATURA_INICIAL", "SALDO_COLEGIATURA_INICIAL",
                         "MONTO_TOTAL", "CANCELADO_TOTAL", "SALDO_TOTAL"], ["CONVENIO", "MES"]),
        ("partner_universities", ["TIPO_PLAN_PAGO", "MONTO_MATRICULA", "SALDO_MATRICULA",
                                  "MONTO_COLEGIATURA1", "SALDO_COLEGIATURA1", "MONTO_CUOTA1",
                                  "SALDO_CUOTA1", "MONTO_TOTAL_PLAN", "SALDO_TOTAL_PLAN"],
         ["CONVENIO", "MES"]),
        ("institute", ["TIPO_PLAN_PAGO", "MONTO_MENSUALIDAD_CUOTA1",
                       "CANCELADO_MENSUALIDAD_CUOTA1", "SALDO_MENSUALIDAD_CUOTA1"],
         ["CONVENIO", "MES"]),
        ("careers", ["ES_CURSO", "MONTO_MENSUALIDAD_CUOTA1", "SALDO_MENSUALIDAD_CUOTA1",
                     "MONTO_TOTAL_PLAN", "SALDO_TOTAL_PLAN"], ["CONVENIO", "MES"]),
        ("kids", ["TIPO_PLAN_PAGO", "ES_CURSO", "MONTO_MENSUALIDAD_CUOTA1",
                  "CANCELADO_MENSUALIDAD_CUOTA1", "SALDO_MENSUALIDAD_CUOTA1", "MONTO_TOTAL_PLAN",
                  "CANCELADO_TOTAL_PLAN", "SALDO_TOTAL_PLAN"], ["MES"]),
        ("technical", ["ES_CURSO", "MONTO_MENSUALIDAD_CUOTA1", "CANCELADO_MENSUALIDAD_CUOTA1",
                       "SALDO_MENSUALIDAD_CUOTA1", "MONTO_CURSO_CUOTA1", "CANCELADO_CURSO_CUOTA1",
                       "SALDO_CURSO_CUOTA1"], ["MES"]),
        ("short_courses", ["MONTO_TOTAL", "MONTO_CANCELADO", "SALDO"], ["CONVENIO", "MES"]),
    ],
)
def test_columns_in_order(small_tables, unit, middle, tail):
    expected = COLUMNS["head"] + middle + COLUMNS["verdict"] + tail
    assert report(small_tables, UNITS[unit], *YEAR).columns == expected


def test_dedup_reports_have_one_row_per_enrolment(small_tables):
    for name in ("initial_fee", "kids", "technical", "institute"):
        rows = report(small_tables, UNITS[name], datetime(1995, 1, 1), as_of="2001-12-31")
        assert rows.groupBy("ID_INSCRIPCION").count().where("count > 1").isEmpty()
