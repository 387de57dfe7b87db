"""Rules cover every enrolment, and filters select what they say."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from enrolmeter import UNITS
from enrolmeter.functions.labels import course_by_category_name
from enrolmeter.operators.balances import Balance
from enrolmeter.plans.report import DATE, VERDICT, rated, run

from .tiny import enrolment, line, payment, tables


@pytest.mark.parametrize("name", UNITS)
def test_an_enrolment_without_lines_is_rated(spark, name):
    everywhere = replace(UNITS[name], sites=None, institutions=None)
    rows = rated(tables(spark), everywhere).collect()
    expected = "NO IDENTIFICADO" if name == "kids" else "NO INSCRITO"
    assert [(r.ID_INSCRIPCION, r[DATE], r[VERDICT]) for r in rows] == [(100, None, expected)]


def test_lines_of_others_do_not_help(spark):
    some = tables(
        spark,
        inscripciones=[enrolment(100), enrolment(101)],
        plan_pagos=[line(1, 101, 27, 300, 0)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-02-03")],
    )
    rows = rated(some, replace(UNITS["institute"], sites=None)).orderBy("ID_INSCRIPCION").collect()
    assert [(r.ID_INSCRIPCION, r[VERDICT]) for r in rows] == [(100, "NO INSCRITO"), (101, "INSCRITO")]
    assert rated(some, UNITS["institute"], complete=False).count() == 1


@pytest.mark.parametrize("filters", [{"sites": ()}, {"institutions": ()}])
def test_an_empty_filter_is_an_error(spark, filters):
    with pytest.raises(ValueError, match="None stands for all"):
        run(tables(spark), replace(UNITS["institute"], **filters), "2026-01-01")


def test_a_balance_without_concepts_is_an_error():
    with pytest.raises(ValueError, match="no concepts"):
        Balance("b", ())


def test_category_names_with_and_without_case(spark):
    names = spark.createDataFrame([("Esam Cursos",), ("ESAM CURSOS",), ("otro",), (None,)], "n string")
    got = names.select(
        course_by_category_name(F.col("n")).alias("exact"),
        course_by_category_name(F.col("n"), ignore_case=True).alias("loose"),
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 1), (0, 0), (0, 0)]
