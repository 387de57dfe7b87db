from datetime import datetime

import pytest
from pyspark.sql import functions as F

from enrolmeter import fixed_values as V
from enrolmeter.functions import labels, rules
from enrolmeter.specs import UNITS

JAN, FEB, MAR = "2026-01-10 00:00:00", "2026-02-10 00:00:00", "2026-03-10 00:00:00"


def evaluate(spark, rule, **columns):
    """The rule over one row; dates are given as text, amounts as numbers."""
    row = spark.range(1)
    for name, value in columns.items():
        kind = (
            "timestamp_ntz" if name.endswith("_fecha")
            else "decimal(28,2)" if name.endswith("_saldo")
            else "string" if isinstance(value, str) else "int"
        )
        row = row.withColumn(name, F.lit(value).cast(kind))
    value = row.select(rule.alias("v")).first()["v"]
    return str(value) if isinstance(value, datetime) else value


def fee(spark, what, **columns):
    unit = UNITS["initial_fee"]
    defaults = dict.fromkeys(
        ("inicial_saldo", "colegiatura_saldo", "inicial_fecha", "colegiatura_fecha")
    )
    return evaluate(spark, getattr(unit, what)(), **{**defaults, **columns})


@pytest.mark.parametrize(
    "one, two, first, second, expected",
    [
        (0, 0, JAN, FEB, JAN),
        (0, 0, MAR, FEB, FEB),
        (0, 0, JAN, JAN, JAN),
        (0, 0, JAN, None, None),  # both settled, no second date: the rule gives no date
        (0, 0, None, FEB, FEB),
        (0, 5, MAR, FEB, MAR),
        (5, 0, JAN, FEB, FEB),
        (5, 5, MAR, FEB, MAR),
        (None, None, None, FEB, FEB),
    ],
)
def test_earliest_settled(spark, one, two, first, second, expected):
    got = fee(
        spark, "date", inicial_saldo=one, colegiatura_saldo=two,
        inicial_fecha=first, colegiatura_fecha=second,
    )
    assert got == expected


@pytest.mark.parametrize(
    "one, two, expected",
    [(0, 9, V.ENROLLED), (9, 0, V.ENROLLED), (9, 9, V.NOT_ENROLLED), (None, None, V.NOT_ENROLLED)],
)
def test_either_settled(spark, one, two, expected):
    assert fee(spark, "condition", inicial_saldo=one, colegiatura_saldo=two) == expected


@pytest.mark.parametrize(
    "fee_owed, tuition, instalment, expected",
    [
        (0, 0, None, V.ENROLLED),
        (None, 0, 7, V.ENROLLED),  # no enrolment fee in the plan passes
        (3, 0, 0, V.NOT_ENROLLED),
        (0, 5, 0, V.NOT_ENROLLED),  # tuition owing: a paid instalment does not help
        (0, None, 0, V.ENROLLED),
        (0, None, None, V.NOT_ENROLLED),
    ],
)
def test_partner_condition(spark, fee_owed, tuition, instalment, expected):
    rule = UNITS["partner_universities"].condition()
    got = evaluate(
        spark, rule, matricula_saldo=fee_owed, colegiatura_saldo=tuition, cuota_saldo=instalment
    )
    assert got == expected


@pytest.mark.parametrize(
    "fee_at, tuition, instalment, expected",
    [
        (JAN, FEB, MAR, FEB),
        (MAR, FEB, None, MAR),
        (JAN, None, MAR, MAR),
        (JAN, None, None, JAN),
        (None, FEB, MAR, FEB),
        (None, None, None, None),
    ],
)
def test_partner_date(spark, fee_at, tuition, instalment, expected):
    rule = UNITS["partner_universities"].date()
    got = evaluate(
        spark, rule, matricula_fecha=fee_at, colegiatura_fecha=tuition, cuota_fecha=instalment
    )
    assert got == expected


@pytest.mark.parametrize(
    "course, plan, dates, owed, expected",
    [
        (1, V.CREDIT_LABEL, (JAN, FEB, MAR), (9, 9, 0), (MAR, V.ENROLLED)),
        (1, V.CREDIT_LABEL, (JAN, FEB, None), (0, 0, None), (None, V.NOT_ENROLLED)),
        (0, V.CASH_LABEL, (JAN, FEB, MAR), (9, 0, 9), (FEB, V.ENROLLED)),
        (0, V.CASH_LABEL, (JAN, None, MAR), (0, None, 0), (None, V.NOT_ENROLLED)),
        (0, V.CREDIT_LABEL, (JAN, None, MAR), (0, 0, 9), (JAN, V.ENROLLED)),
        (0, V.CREDIT_LABEL, (JAN, FEB, MAR), (9, 0, 0), (FEB, V.NOT_ENROLLED)),
    ],
)
def test_postgraduate_rules(spark, course, plan, dates, owed, expected):
    unit = UNITS["postgraduate"]
    row = dict(zip(("matricula_fecha", "colegiatura_fecha", "plan_fecha"), dates))
    row |= dict(zip(("matricula_saldo", "colegiatura_saldo", "plan_saldo"), owed))
    row |= {"ES_CURSO": course, "TIPO_PLAN_PAGO": plan}
    got = evaluate(spark, unit.date(), **row), evaluate(spark, unit.condition(), **row)
    assert got == expected


@pytest.mark.parametrize(
    "category, expected",
    [(12, (FEB, V.ENROLLED)), (35, (JAN, V.NOT_ENROLLED)), (18, (None, V.UNIDENTIFIED))],
)
def test_kids_rules(spark, category, expected):
    unit = UNITS["kids"]
    row = {
        "ID_CATEGORIA": category, "mensualidad_fecha": JAN, "cursos_fecha": FEB,
        "mensualidad_saldo": 4, "cursos_saldo": 0,
    }
    got = evaluate(spark, unit.date(), **row), evaluate(spark, unit.condition(), **row)
    assert got == expected


def test_state_words(spark):
    codes = spark.createDataFrame([(c,) for c in (0, 5, 6, -1, None)], "c int")
    got = [r.v for r in codes.select(labels.enrolment_state(F.col("c")).alias("v")).collect()]
    assert got == ["PRE-INSCRITO", "PAGADO"] + ["NO IDENTIFICADO"] * 3


def test_month_words(spark):
    days = spark.createDataFrame(
        [(f"2026-{m:02d}-15",) for m in range(1, 13)] + [(None,)], "d string"
    )
    got = days.select(labels.month_label(F.col("d").cast("timestamp_ntz")).alias("v")).collect()
    assert [r.v for r in got] == [
        "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
        "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE", None,
    ]


def test_plan_type_and_course_title(spark):
    names = spark.createDataFrame([(n,) for n in ("al contado", "Credito", "Cursos", None)], "n string")
    got = names.select(
        labels.plan_type(F.col("n")).alias("p"), labels.course_by_title(F.col("n")).alias("c")
    ).collect()
    assert [r.p for r in got] == [V.CASH_LABEL] + [V.CREDIT_LABEL] * 3
    assert [r.c for r in got] == [0, 0, 1, 0]


def test_full_name_skips_null_but_not_empty_parts(spark):
    got = spark.sql("SELECT 'Ana' a, '' b, CAST(NULL AS STRING) c").select(
        labels.full_name(F.col("a"), F.col("b"), F.col("c")).alias("v"),
        labels.full_name(F.col("c"), F.col("c")).alias("none"),
    ).first()
    assert (got.v, got.none) == ("Ana ", "")


@pytest.mark.parametrize(
    "moment, inside",
    [
        ("2026-01-01 00:00:00", True),
        ("2025-12-31 23:59:59.999", False),
        ("2026-06-30 23:59:59", True),
        ("2026-06-30 23:59:59.5", False),
        (None, False),
    ],
)
def test_period_bounds_are_closed_to_the_second(spark, moment, inside):
    row = spark.range(1).select(F.lit(moment).cast("timestamp_ntz").alias("d"))
    period = rules.within_period(F.col("d"), "2026-01-01 00:00:00", "2026-06-30 23:59:59")
    assert (row.where(period).count() == 1) is inside


def test_open_period_ends_at_as_of_or_now(spark):
    row = spark.sql(
        "SELECT CAST(current_timestamp() AS TIMESTAMP_NTZ) + INTERVAL 1 DAY AS later, "
        "CAST(current_timestamp() AS TIMESTAMP_NTZ) - INTERVAL 1 DAY AS earlier"
    )
    start = datetime(2020, 1, 1)
    assert row.where(rules.within_period(F.col("later"), start)).isEmpty()
    assert not row.where(rules.within_period(F.col("earlier"), start)).isEmpty()
    assert row.where(rules.within_period(F.col("earlier"), start, as_of="2021-01-01")).isEmpty()


def test_period_bounds_carry_no_zone(spark):
    with pytest.raises(ValueError):
        rules.within_period(F.col("d"), "2026-01-01T00:00:00+00:00")
