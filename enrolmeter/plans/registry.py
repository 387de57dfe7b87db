"""Every operator and report as a query over the twelve logical tables.

Each entry takes the tables and returns a DataFrame over all their rows. Operator entries
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import specs as S
from ..functions import labels
from ..functions.rules import settled, settled_or_absent, within_period
from ..operators import balances as B
from ..operators import star
from .report import DATE, ID, VERDICT, rated, run

# The test files' payments run from 1995 to 2001; fixed bounds keep results comparable.
START, END = "1996-01-01 00:00:00", "2000-12-31 23:59:59"

Query = Callable[[dict], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- scans and the star: S1-S12, J1-J9, F1-F4, F22, X12, X19 -------------------------------


@_query
def scan_enrolments(t):
    return t["inscripciones"]


@_query
def program_hierarchy(t):
    return (
        star.enrolment_rows(t)
        .join(star.program_hierarchy(t), "ID_PROGRAMA")
        .select(ID, "ID_PROGRAMA", "COD_CONTABLE", "PROGRAMA", "ID_CATEGORIA", "TIPO_PROGRAMA")
    )


@_query
def site_unit(t):
    programs = star.attach_site(star.program_hierarchy(t), t)
    return programs.select("ID_PROGRAMA", "ID_SEDE", "SEDE", "UNIDAD")


@_query
def agreement_label(t):
    programs = star.attach_agreement(star.program_hierarchy(t), t)
    return programs.select("ID_PROGRAMA", "ID_INSTITUCION", "CONVENIO")


@_query
def plan_type(t):
    return star.attach_plan_type(star.enrolment_rows(t), t).select(ID, "TIPO_PLAN_PAGO")


@_query
def person_roles(t):
    return star.attach_people(star.enrolment_rows(t), t).select(
        ID, "ALUMNO", "CI_ALUMNO", "ASESOR", "CI_ASESOR"
    )


@_query
def full_name(t):
    return t["personas"].select(
        "id",
        labels.full_name(F.col("nombres"), F.col("pri_apellido"), F.col("seg_apellido")).alias(
            "NOMBRE_COMPLETO"
        ),
    )


@_query
def enrolment_base(t):
    return star.enrolment_base(t).select(
        "UNIDAD", "SEDE", "ASESOR", "CI_ASESOR", "ALUMNO", "CI_ALUMNO", "TIPO_PROGRAMA", ID,
        "COD_CONTABLE", "PROGRAMA", "ID_PROGRAMA", "TIPO_PLAN_PAGO", "CONVENIO", "estado_ins",
        "fecha_creacion_inscripcion",
    )


def _filtered(t, sites=None, institutions=None):
    programs = star.program_catalogue(t, sites, institutions)
    return (
        star.enrolment_rows(t)
        .join(programs, "ID_PROGRAMA")
        .select(ID, "ID_PROGRAMA", "ID_SEDE", "SEDE", "ID_INSTITUCION", "CONVENIO")
    )


@_query
def filter_sites(t):
    return _filtered(t, sites=V.SHORT_COURSE_SITES)


@_query
def filter_single_site(t):
    return _filtered(t, sites=V.TECHNICAL_SITES)


@_query
def filter_institution(t):
    return _filtered(t, institutions=V.INITIAL_FEE_INSTITUTIONS)


@_query
def filter_institution_list(t):
    return _filtered(t, institutions=V.PARTNER_INSTITUTIONS)


# --- payments and balances: A1-A11, F5-F12, J10-J14 ----------------------------------------

_INITIAL = B.Balance("inicial", (V.INITIAL_FEE,), first_only=True)
_FEE_RAW = B.Balance("matricula", (V.ENROLMENT_FEE,), payments="raw")
_TUITION_RAW = B.Balance("colegiatura", (V.TUITION,), first_only=True, payments="raw")
_COURSE_RAW = B.Balance("curso", (V.COURSE,), payments="raw")


@_query
def payments_info(t):
    return B.payments_info(t["detalle_pagos_inscripcion"], t["pagos_inscripcion"])


@_query
def concept_balance(t):
    return B.enrolment_balances(t, _INITIAL, receipt=True)


@_query
def concept_balance_all_quotas(t):
    return B.enrolment_balances(t, B.Balance("cursos", (V.KIDS_COURSE,)))


@_query
def concept_balance_raw(t):
    return B.enrolment_balances(t, _FEE_RAW, receipt=True)


@_query
def concept_balance_multi(t):
    concepts = (V.MONTHLY_FEE, V.CONTINUING_COURSE)
    return B.enrolment_balances(t, B.Balance("plan", concepts, payments="raw"))


@_query
def concept_balance_by_value(t):
    lines = B.paid_lines(t, (_TUITION_RAW,), receipt=True)
    return B.balance_by_value(lines, _TUITION_RAW, receipt=True)


@_query
def plan_total(t):
    return B.enrolment_balances(t, B.Balance("plan", payments="none"))


@_query
def plan_total_raw(t):
    return B.enrolment_balances(t, B.Balance("plan", payments="raw"))


@_query
def collected_amount(t):
    return B.enrolment_balances(t, _COURSE_RAW).select(
        "inscripcion_id", "curso_monto", "curso_cancelado", "curso_saldo"
    )


@_query
def receipt_void_semantics(t):
    """A voided receipt keeps its payment's date in raw mode and drops it in dedup mode."""
    raw = B.enrolment_balances(t, replace(_COURSE_RAW, name="raw"), receipt=True)
    dedup = B.enrolment_balances(
        t, replace(_COURSE_RAW, name="dedup", payments="dedup"), receipt=True
    )
    return raw.join(dedup, "inscripcion_id").select(
        "inscripcion_id", "raw_fecha", "raw_recibo", "dedup_fecha", "dedup_recibo"
    )


def _all_enrolments_with(t, *balances):
    totals = B.enrolment_balances(t, *balances).withColumnRenamed("inscripcion_id", ID)
    return star.enrolment_rows(t).select(ID).join(totals, ID, "left")


@_query
def enrolment_balances(t):
    return _all_enrolments_with(t, *S.PARTNER_UNIVERSITIES.balances).drop(
        *(f"{b.name}_cancelado" for b in S.PARTNER_UNIVERSITIES.balances)
    )


@_query
def null_default_money(t):
    rows = _all_enrolments_with(t, _INITIAL)
    return rows.select(
        ID,
        *(
            labels.money(F.col(f"inicial_{m.lower()}")).alias(m)
            for m in ("MONTO", "CANCELADO", "SALDO")
        ),
    )


@_query
def settled_flag(t):
    rows = _all_enrolments_with(t, _INITIAL)
    return rows.select(ID, labels.flag(settled(F.col("inicial_saldo"))).alias("SALDADO"))


@_query
def settled_or_absent_flag(t):
    rows = _all_enrolments_with(t, _FEE_RAW)
    return rows.select(
        ID, labels.flag(settled_or_absent(F.col("matricula_saldo"))).alias("SALDADO_O_SIN_PLAN")
    )


# --- classifiers: B1-B7, F16-F18, X7-X9, X13-X15 -------------------------------------------


@_query
def like_contains(t):
    title = F.col("nombre_compuesto")
    return t["programas"].where(labels.contains_word(title, V.COURSE_MARK)).select("id", title)


@_query
def is_course_by_name(t):
    name = F.col("TIPO_PROGRAMA")
    return star.program_hierarchy(t).select(
        "ID_PROGRAMA", name, labels.course_by_category_name(name).alias("ES_CURSO")
    )


@_query
def is_course_by_id(t):
    category = F.col("ID_CATEGORIA")
    return star.program_hierarchy(t).select(
        "ID_PROGRAMA",
        category,
        labels.course_by_category_id(category, V.CAREER_COURSE_CATEGORIES).alias("ES_CURSO_CARRERA"),
        labels.course_by_category_id(category, V.KIDS_COURSE_CATEGORIES).alias("ES_CURSO_INFANTIL"),
    )


@_query
def is_course_by_title(t):
    title = F.col("nombre_compuesto")
    return t["programas"].select("id", title, labels.course_by_title(title).alias("ES_CURSO"))


@_query
def state_decode(t):
    return t["inscripciones"].select(
        "id", labels.enrolment_state(F.col("estado_ins")).alias("ESTADO_INSCRIPCION")
    )


@_query
def month_name(t):
    return t["inscripciones"].select("id", labels.month_label(F.col("created_at")).alias("MES"))


# --- date, condition and period rules over every site: R1-R8, K1-K8, F13-F15, F19-F21 -------


def _everywhere(t, spec):
    return rated(t, replace(spec, sites=None, institutions=None))


@_query
def date_rule_fallback(t):
    return _everywhere(t, S.POSTGRADUATE).select(
        ID, "ES_CURSO", "TIPO_PLAN_PAGO", "colegiatura_monto", "colegiatura_saldo", DATE
    )


@_query
def date_rule_earliest(t):
    return _everywhere(t, S.INITIAL_FEE).select(ID, "inicial_fecha", "colegiatura_fecha", DATE)


@_query
def date_rule_latest(t):
    return _everywhere(t, S.PARTNER_UNIVERSITIES).select(ID, DATE)


@_query
def date_rule_by_flag(t):
    return _everywhere(t, S.CAREERS).select(ID, "ES_CURSO", DATE, VERDICT)


@_query
def date_rule_by_category(t):
    return _everywhere(t, S.KIDS).select(ID, "ID_CATEGORIA", DATE, VERDICT)


@_query
def condition_by_product(t):
    return _everywhere(t, S.POSTGRADUATE).select(ID, "ES_CURSO", "TIPO_PLAN_PAGO", VERDICT)


@_query
def condition_or(t):
    return _everywhere(t, S.INITIAL_FEE).select(ID, "inicial_saldo", "colegiatura_saldo", VERDICT)


@_query
def condition_and(t):
    return _everywhere(t, S.PARTNER_UNIVERSITIES).select(
        ID, "matricula_saldo", "colegiatura_saldo", "cuota_saldo", VERDICT
    )


@_query
def period_filter_computed(t):
    rows = _everywhere(t, S.INITIAL_FEE).where(within_period(F.col(DATE), START, as_of=END))
    return rows.select(ID, DATE)


@_query
def period_filter_open(t):
    rows = _everywhere(t, S.SHORT_COURSES).where(
        within_period(F.col(DATE), START, as_of="1998-06-30 12:00:00")
    )
    return rows.select(ID, DATE)


@_query
def period_filter_fixed(t):
    rows = _everywhere(t, S.INSTITUTE).where(
        within_period(F.col(DATE), "1996-07-01 00:00:00", "1996-12-31 23:59:59")
    )
    return rows.select(ID, DATE)


# --- the eight reports and their deduplicated forms: Q1-Q10, O1, O2, J15 --------------------


def _report(spec):
    return lambda t: run(t, spec, START, END)


for _spec in S.UNITS.values():
    QUERIES[f"report_{_spec.name}"] = _report(_spec)
    if any(b.payments == "raw" for b in _spec.balances):
        _dedup = S.deduplicated(_spec)
        QUERIES[f"report_{_dedup.name}"] = _report(_dedup)
