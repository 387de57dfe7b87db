"""Column expressions that turn stored codes and names into report labels.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def _labels(words: Sequence[str]) -> Column:
    """The words as one array constant; the optimizer folds it."""
    return F.expr("array(" + ", ".join(f"'{word}'" for word in words) + ")")


def contains_word(text: Column, word: str) -> Column:
    """Does ``text`` contain ``word`` (given in capitals), whatever its case? NULL stays NULL."""
    return F.upper(text).contains(word)


def plan_type(plan_name: Column) -> Column:
    """Cash plans say so in their name; every other plan, a missing one too, is credit."""
    return F.when(contains_word(plan_name, V.CASH_MARK), V.CASH_LABEL).otherwise(V.CREDIT_LABEL)


def flag(test: Column) -> Column:
    """1 where ``test`` holds, 0 where it is false or unknown."""
    return F.when(test, 1).otherwise(0)


def course_by_category_name(name: Column, ignore_case: bool = False) -> Column:
    """Is the category one of the course categories? Exact by default; ``ignore_case`` compares
    as a database with a case-insensitive collation does."""
    if ignore_case:
        return flag(F.upper(name).isin(*(n.upper() for n in V.COURSE_CATEGORY_NAMES)))
    return flag(name.isin(*V.COURSE_CATEGORY_NAMES))


def course_by_category_id(category: Column, ids: Sequence[int]) -> Column:
    return flag(category.isin(*ids))


def course_by_title(title: Column) -> Column:
    return flag(contains_word(title, V.COURSE_MARK))


def enrolment_state(code: Column) -> Column:
    """State code to word; NULL and codes outside the list are unidentified."""
    return F.coalesce(F.get(_labels(V.STATE_LABELS), code), F.lit(V.UNIDENTIFIED))


def agreement(abbreviation: Column) -> Column:
    return F.coalesce(abbreviation, F.lit(V.NO_AGREEMENT_LABEL))


def month_label(when: Column) -> Column:
    """Spanish month name. A lookup, because ``date_format`` depends on the JVM's locale.

    The label has no year: a period longer than twelve months merges equal months.
    """
    return F.get(_labels(V.MONTH_LABELS), F.month(when) - 1)


def full_name(*parts: Column) -> Column:
    """Parts joined by a blank, NULL parts left out; '' when all parts are NULL."""
    return F.concat_ws(" ", *parts)


def money(amount: Column) -> Column:
    """Amount shown in a report: 0 where there is none."""
    return F.coalesce(amount, F.lit(0).cast("decimal(28,2)"))
