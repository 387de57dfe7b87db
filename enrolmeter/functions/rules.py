"""Rules for the deciding payment date and the enrolled / not enrolled verdict.

A rule reads balance columns by the balance's name: ``<name>_fecha`` (last payment) and
``<name>_saldo`` (amount outstanding). Each rule is one Column, computed once per report
and then used for the date column, the month and the period filter.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def paid_at(balance: str) -> Column:
    return F.col(f"{balance}_fecha")


def owed(balance: str) -> Column:
    return F.col(f"{balance}_saldo")


# --- settled tests -----------------------------------------------------------------------


def settled(*amounts: Column) -> Column:
    """The first known amount is 0. With none known the answer is no."""
    return F.coalesce(*amounts, F.lit(1)) == 0


def settled_or_absent(amount: Column) -> Column:
    """The amount is 0, or there is none."""
    return F.coalesce(amount, F.lit(0)) == 0


def verdict(test: Column) -> Column:
    return F.when(test, V.ENROLLED).otherwise(V.NOT_ENROLLED)


# --- deciding dates ------------------------------------------------------------------


def first_known(*dates: Column) -> Column:
    return F.coalesce(*dates)


def latest_known(*dates: Column) -> Column:
    """Latest of the dates that are set. Spark's ``greatest`` passes over NULLs, so one
    missing date leaves the other standing, with no guard around it."""
    return F.greatest(*dates)


def earliest_settled(first: str, second: str) -> Column:
    """Date of the settled balance; with both settled the earlier one.

    A settled pair without a comparable date yields the second date, be it NULL: the first
    is taken only where it is known to be no later.
    """
    one, two = paid_at(first), paid_at(second)
    both = F.when(one <= two, one).otherwise(two)
    first_ok, second_ok = settled(owed(first)), settled(owed(second))
    return (
        F.when(first_ok & second_ok, both)
        .when(first_ok, one)
        .when(second_ok, two)
        .otherwise(first_known(one, two))
    )


def by_course(course: Column, other: Column) -> Column:
    """One rule for courses, another for the rest (``ES_CURSO`` set by the unit)."""
    return F.when(F.col("ES_CURSO") == 1, course).otherwise(other)


def by_kids_category(courses: Column, monthly: Column, other: Column | None = None) -> Column:
    """Rule by program category; categories outside both lists get ``other`` (NULL)."""
    category = F.col("ID_CATEGORIA")
    picked = F.when(category.isin(*V.KIDS_COURSE_CATEGORIES), courses).when(
        category.isin(*V.KIDS_MONTHLY_CATEGORIES), monthly
    )
    return picked if other is None else picked.otherwise(other)


def pays_cash() -> Column:
    return F.col("TIPO_PLAN_PAGO") == V.CASH_LABEL


# --- period ------------------------------------------------------------------------------


def _moment(bound: str | datetime) -> Column:
    if isinstance(bound, str):
        bound = datetime.fromisoformat(bound)
    if bound.tzinfo is not None:
        raise ValueError("period bounds are local moments; give them without a time zone")
    return F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")


def within_period(
    date: Column,
    start: str | datetime,
    end: str | datetime | None = None,
    as_of: str | datetime | None = None,
) -> Column:
    """``start <= date <= end``, both ends included and NULL dates out.

    Without ``end`` the period runs to ``as_of``; without that to now, to the second, in
    the session's time zone. Bounds are typed literals by the time a plan is optimized.
    """
    last = end if end is not None else as_of
    if last is None:
        upper = F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz")
    else:
        upper = _moment(last)
    return date.between(_moment(start), upper)
