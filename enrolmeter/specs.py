"""The eight unit reports as data. ``report.run`` is the one pipeline that reads them.

"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .functions import labels
from .functions.rules import (
    by_course,
    by_kids_category,
    earliest_settled,
    first_known,
    latest_known,
    owed,
    paid_at,
    pays_cash,
    settled,
    settled_or_absent,
    verdict,
)
from .operators.balances import Balance

Rule = Callable[[], Column]


@dataclass(frozen=True)
class UnitSpec:
    name: str
    sites: tuple[int, ...] | None  # None: every site
    balances: tuple[Balance, ...]
    money: Mapping[str, str]  # report column -> balance column, in report order
    date: Rule
    condition: Rule
    institutions: tuple[int, ...] | None = None  # None: every partner, or none
    by_value: Balance | None = None  # balance kept per distinct value, not summed
    course: Rule | None = None  # ES_CURSO, over program columns
    category: bool = False  # the rules read ID_CATEGORIA
    plan_type: bool = True  # show TIPO_PLAN_PAGO
    plan_in_rule: bool = False  # the date rule reads TIPO_PLAN_PAGO
    agreement: bool = True  # show CONVENIO
    created: bool = False  # show fecha_creacion_inscripcion
    order_by_date_of: str | None = None  # balance whose date orders the rows, else the id


def _shown(measures: tuple[str, ...], **suffixes: str) -> dict[str, str]:
    """``MEASURE_SUFFIX`` columns for each balance, e.g. MONTO_MATRICULA."""
    return {
        f"{measure}_{suffix}": f"{balance}_{measure.lower()}"
        for balance, suffix in suffixes.items()
        for measure in measures
    }


_OWED = ("MONTO", "SALDO")
_FULL = ("MONTO", "CANCELADO", "SALDO")


# Q1, R1, K1: courses by the whole plan, cash plans by tuition, credit by fee and tuition.
POSTGRADUATE = UnitSpec(
    name="postgraduate",
    sites=V.POSTGRADUATE_SITES,
    institutions=V.POSTGRADUATE_INSTITUTIONS,
    balances=(
        Balance("matricula", (V.ENROLMENT_FEE,), payments="raw"),
        Balance("plan", payments="raw"),
    ),
    by_value=Balance("colegiatura", (V.TUITION,), first_only=True, payments="raw"),
    money=_shown(
        _OWED, matricula="MATRICULA", colegiatura="COLEGIATURA_CUOTA1", plan="TOTAL_PLAN"
    ),
    course=lambda: labels.course_by_category_name(F.col("TIPO_PROGRAMA")),
    category=True,
    plan_in_rule=True,
    date=lambda: by_course(
        paid_at("plan"),
        F.when(pays_cash(), paid_at("colegiatura")).otherwise(
            first_known(paid_at("colegiatura"), paid_at("matricula"))
        ),
    ),
    condition=lambda: verdict(
        by_course(
            settled(owed("plan")),
            settled(owed("colegiatura")) & (pays_cash() | settled(owed("matricula"))),
        )
    ),
    created=True,
    order_by_date_of="colegiatura",
)

# Q2, R2, K2: the initial fee or the first tuition settles the enrolment.
INITIAL_FEE = UnitSpec(
    name="initial_fee",
    sites=V.INITIAL_FEE_SITES,
    institutions=V.INITIAL_FEE_INSTITUTIONS,
    balances=(
        Balance("inicial", (V.INITIAL_FEE,), first_only=True),
        Balance("colegiatura", (V.TUITION,), first_only=True),
        Balance("plan", payments="none"),
    ),
    money=_shown(_FULL, inicial="CUOTA_INICIAL", colegiatura="COLEGIATURA_INICIAL", plan="TOTAL"),
    date=lambda: earliest_settled("inicial", "colegiatura"),
    condition=lambda: verdict(settled(owed("inicial")) | settled(owed("colegiatura"))),
)

# Q3, R3, K3: the enrolment fee, where there is one, and the first tuition or instalment.
PARTNER_UNIVERSITIES = UnitSpec(
    name="partner_universities",
    sites=V.PARTNER_SITES,
    institutions=V.PARTNER_INSTITUTIONS,
    balances=(
        Balance("matricula", (V.ENROLMENT_FEE,), payments="raw"),
        Balance("colegiatura", (V.TUITION,), first_only=True, payments="raw"),
        Balance("cuota", (V.PARTNER_INSTALMENT,), first_only=True, payments="raw"),
        Balance("plan", payments="none"),
    ),
    money=_shown(
        _OWED, matricula="MATRICULA", colegiatura="COLEGIATURA1", cuota="CUOTA1", plan="TOTAL_PLAN"
    ),
    date=lambda: latest_known(
        paid_at("matricula"), first_known(paid_at("colegiatura"), paid_at("cuota"))
    ),
    condition=lambda: verdict(
        settled_or_absent(owed("matricula")) & settled(owed("colegiatura"), owed("cuota"))
    ),
)

# Q4, R4, K4: first monthly fee.
INSTITUTE = UnitSpec(
    name="institute",
    sites=V.INSTITUTE_SITES,
    balances=(Balance("mensualidad", (V.MONTHLY_FEE_SCHOOL,), first_only=True),),
    money=_shown(_FULL, mensualidad="MENSUALIDAD_CUOTA1"),
    date=lambda: paid_at("mensualidad"),
    condition=lambda: verdict(settled(owed("mensualidad"))),
)

# Q5, R5, K5: courses by monthly fees and continuing courses together, careers by the first fee.
CAREERS = UnitSpec(
    name="careers",
    sites=V.CAREER_SITES,
    balances=(
        Balance("mensualidad", (V.MONTHLY_FEE,), first_only=True, payments="raw"),
        Balance("plan", (V.MONTHLY_FEE, V.CONTINUING_COURSE), payments="raw"),
    ),
    money=_shown(_OWED, mensualidad="MENSUALIDAD_CUOTA1", plan="TOTAL_PLAN"),
    course=lambda: labels.course_by_category_id(F.col("ID_CATEGORIA"), V.CAREER_COURSE_CATEGORIES),
    category=True,
    plan_type=False,
    date=lambda: by_course(paid_at("plan"), paid_at("mensualidad")),
    condition=lambda: verdict(by_course(settled(owed("plan")), settled(owed("mensualidad")))),
)

# Q6, R6, K6: by category, the course concept or the first monthly fee.
KIDS = UnitSpec(
    name="kids",
    sites=V.KIDS_SITES,
    balances=(
        Balance("mensualidad", (V.MONTHLY_FEE_SCHOOL,), first_only=True),
        Balance("cursos", (V.KIDS_COURSE,)),
    ),
    money=_shown(_FULL, mensualidad="MENSUALIDAD_CUOTA1", cursos="TOTAL_PLAN"),
    course=lambda: labels.course_by_category_id(F.col("ID_CATEGORIA"), V.KIDS_COURSE_CATEGORIES),
    category=True,
    date=lambda: by_kids_category(paid_at("cursos"), paid_at("mensualidad")),
    condition=lambda: by_kids_category(
        verdict(settled(owed("cursos"))),
        verdict(settled(owed("mensualidad"))),
        F.lit(V.UNIDENTIFIED),
    ),
    agreement=False,
)

# Q7, R7, K7: by title, the first course instalment or the first monthly fee.
TECHNICAL = UnitSpec(
    name="technical",
    sites=V.TECHNICAL_SITES,
    balances=(
        Balance("mensualidad", (V.MONTHLY_FEE,), first_only=True),
        Balance("curso", (V.COURSE,), first_only=True),
    ),
    money=_shown(_FULL, mensualidad="MENSUALIDAD_CUOTA1", curso="CURSO_CUOTA1"),
    course=lambda: labels.course_by_title(F.col("PROGRAMA")),
    plan_type=False,
    date=lambda: by_course(paid_at("curso"), paid_at("mensualidad")),
    condition=lambda: verdict(by_course(settled(owed("curso")), settled(owed("mensualidad")))),
    agreement=False,
)

# Q8, R8, K8: every instalment of the course concept.
SHORT_COURSES = UnitSpec(
    name="short_courses",
    sites=V.SHORT_COURSE_SITES,
    balances=(Balance("curso", (V.COURSE,), payments="raw"),),
    money={
        "MONTO_TOTAL": "curso_monto",
        "MONTO_CANCELADO": "curso_cancelado",
        "SALDO": "curso_saldo",
    },
    plan_type=False,
    date=lambda: paid_at("curso"),
    condition=lambda: verdict(settled(owed("curso"))),
)

UNITS: dict[str, UnitSpec] = {
    spec.name: spec
    for spec in (
        POSTGRADUATE, INITIAL_FEE, PARTNER_UNIVERSITIES, INSTITUTE,
        CAREERS, KIDS, TECHNICAL, SHORT_COURSES,
    )
}


def deduplicated(spec: UnitSpec) -> UnitSpec:
    """Q9: the same report with partial payments collapsed before amounts are summed."""

    def collapse(b: Balance) -> Balance:
        return replace(b, payments="dedup") if b.payments == "raw" else b

    return replace(
        spec,
        name=f"{spec.name}_dedup",
        balances=tuple(map(collapse, spec.balances)),
        by_value=spec.by_value and collapse(spec.by_value),
    )
