"""One pipeline for every unit report.

Each fact table is scanned and shuffled once per report. A report that keeps a balance per distinct
value groups by enrolment and value first, then those rows by enrolment; both read one shuffle.

1. enrolments of the unit's programs, as fixed-width columns (program side broadcast if
   Spark finds it small);
2. plan lines of the wanted concepts meet those enrolments, so other units' lines leave
   before anything is summed;
3. payments, already one row per instalment, meet the lines one to one;
4. one grouping yields all balances; the enrolment's own columns ride along as keys, which
   saves joining the balances back;
5. date rule and period filter run on one row per enrolment;
6. only rows that are left fetch names, titles and people.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.rules import within_period
from ..operators.balances import ENROLMENT, balance_totals, paid_lines, valued_totals
from ..operators.star import (
    attach_category,
    attach_people,
    attach_plan_type,
    enrolment_rows,
    one_of,
    program_catalogue,
)
from ..sources.tables import Tables
from ..specs import UnitSpec

ID = "ID_INSCRIPCION"
DATE = "FECHA_PAGO_DECISIVA"
VERDICT = "CONDICION_INSCRITO"
HEAD = (
    "UNIDAD", "SEDE", "ASESOR", "CI_ASESOR", "ALUMNO", "CI_ALUMNO",
    "TIPO_PROGRAMA", ID, "COD_CONTABLE", "PROGRAMA", "ID_PROGRAMA",
)


def run(
    tables: Tables,
    spec: UnitSpec,
    start: str | datetime,
    end: str | datetime | None = None,
    as_of: str | datetime | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The unit's report for payments from ``start`` to ``end`` (or ``as_of``, or now).

    ``ordered=False`` leaves out the final global sort, for callers that store the result.
    """
    rows = rated(tables, spec, complete=False).where(within_period(F.col(DATE), start, end, as_of))
    if spec.plan_type and not spec.plan_in_rule:
        rows = attach_plan_type(rows, tables)
    catalogue = program_catalogue(tables, spec.sites, spec.institutions, spec.agreement)
    rows = rows.drop("ID_CATEGORIA").join(catalogue, "ID_PROGRAMA")
    rows = attach_people(rows, tables)

    if ordered:
        rows = rows.orderBy(*_order(spec))
    return rows.select(*_columns(spec))


def rated(tables: Tables, spec: UnitSpec, complete: bool = True) -> DataFrame:
    """The unit's enrolments with balances, deciding date and verdict, of any period.

    ``complete=False`` leaves out enrolments without a line in any of the unit's balances.
    They have no date, so that a period filter would drop them in any case.
    """
    rows = with_balances(tables, spec, unit_enrolments(tables, spec), complete)
    if spec.plan_in_rule:
        rows = attach_plan_type(rows, tables)
    return rows.withColumns({DATE: spec.date(), VERDICT: spec.condition()})


def unit_enrolments(tables: Tables, spec: UnitSpec) -> DataFrame:
    """The unit's enrolments with what the rules read of their program, all fixed width."""
    programs = tables["programas"]
    if spec.sites is not None:
        programs = programs.where(one_of("idsede", spec.sites))
    if spec.institutions is not None:
        programs = programs.where(one_of("iduniversidad", spec.institutions))
    programs = programs.select(
        F.col("id").alias("ID_PROGRAMA"), F.col("nombre_compuesto").alias("PROGRAMA"), "idpostgrado"
    )
    kept = ["ID_PROGRAMA"]
    if spec.category:
        programs = attach_category(programs, tables)
        kept.append("ID_CATEGORIA")
    if spec.course is not None:
        programs = programs.withColumn("ES_CURSO", spec.course())
        kept.append("ES_CURSO")
    unused = [] if spec.created else ["fecha_creacion_inscripcion"]
    if not spec.plan_type:
        unused.append("plan_cobro_programa_id")
    # With nothing to carry over, a semi join also keeps Spark's size estimate sound.
    how = "left_semi" if kept == ["ID_PROGRAMA"] else "inner"
    return enrolment_rows(tables).drop(*unused).join(programs.select(*kept), "ID_PROGRAMA", how)


def with_balances(
    tables: Tables, spec: UnitSpec, enrolments: DataFrame, complete: bool = True
) -> DataFrame:
    """Enrolments with the unit's balances: all of them, or those with a line in one.

    All of them meet balances that are grouped by the id alone, one row each, so that an
    enrolment with very many lines is reduced before the outer join, which could not split it.
    """
    if complete:
        lines, keys = tables["plan_pagos"].withColumnRenamed(ENROLMENT, ID), [ID]
    else:
        lines, keys = _lines_of(tables, enrolments), enrolments.columns
    if spec.by_value is None:
        totals = balance_totals(paid_lines(tables, spec.balances, lines), spec.balances, keys)
        return enrolments.join(totals, ID, "left") if complete else totals
    if not complete:
        # The report's inner join with students would drop these from one of the two sides only,
        # and the grouping would no longer be the same for both.
        lines = lines.where(F.col("idestudiante").isNotNull())
    lines = paid_lines(tables, (*spec.balances, spec.by_value), lines)
    totals, values = valued_totals(lines, spec.balances, spec.by_value, keys)
    rows = enrolments.join(totals, ID, "left").fillna(0, ["has_values"]) if complete else totals
    return _once_per_value(rows, values)


def _lines_of(tables: Tables, enrolments: DataFrame) -> DataFrame:
    return tables["plan_pagos"].withColumnRenamed(ENROLMENT, ID).join(enrolments, ID)


def _once_per_value(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Repeat an enrolment once per distinct value of the by-value balance.

    An outer join would put all values of one enrolment into one task: only its preserved
    side can be split. So enrolments with values are joined inner, where either side can,
    and those without are added. All three read the same shuffled grouping, which stays one
    only while they ask for the same columns of it. Hence the ``own_`` columns: a value's share
    of a total is NULL where the total is, so it never shows behind it.
    """
    shares = [c for c in values.columns if c.startswith("own_")]
    found = values.select(ID, *shares, *(c for c in values.columns if c not in {*rows.columns, *shares}))
    kept = [c for c in rows.columns if not c.startswith("any_") and c != "has_values"]
    without = rows.where(F.col("has_values") == 0)
    matched = rows.where(F.col("has_values") == 1).join(found, ID)
    # The latest payment of all values: of enrolments without any it is NULL, as it must be.
    for mark in (c for c in rows.columns if c.startswith("any_")):
        matched = matched.withColumn(mark[4:], F.coalesce(mark[4:], F.when(F.col(mark).isNull(), F.col(mark))))
        without = without.withColumnRenamed(mark, mark[4:])
    return matched.select(
        *(F.coalesce(F.col(c), F.col(f"own_{c}")).alias(c) if f"own_{c}" in shares else c for c in kept),
        *(c for c in found.columns if c not in {ID, *shares}),
    ).unionByName(without.drop("has_values"), allowMissingColumns=True)


def _order(spec: UnitSpec) -> list[Column]:
    by_id = F.col(ID).asc()
    if spec.order_by_date_of is None:
        return [by_id]
    # The date leaves ties open; the rest settles them, one enrolment's values included.
    dated = spec.order_by_date_of
    ties = [F.col(f"{dated}_{m}").asc_nulls_first() for m in ("monto", "saldo")]
    return [F.col(f"{dated}_fecha").asc_nulls_first(), by_id, *ties]


def _columns(spec: UnitSpec) -> list[Column | str]:
    out: list[Column | str] = [*HEAD]
    if spec.plan_type:
        out.append("TIPO_PLAN_PAGO")
    if spec.course is not None:
        out.append("ES_CURSO")
    out += [labels.money(F.col(source)).alias(shown) for shown, source in spec.money.items()]
    out += [
        DATE,
        VERDICT,
        labels.enrolment_state(F.col("estado_ins")).alias("ESTADO_INSCRIPCION"),
    ]
    if spec.agreement:
        out.append("CONVENIO")
    out.append(labels.month_label(F.col(DATE)).alias("MES"))
    if spec.created:
        out.append("fecha_creacion_inscripcion")
    return out
