"""Hand-made logical tables: one program, site and pair of people, plus what a test adds."""

from datetime import datetime
from decimal import Decimal

from enrolmeter.sources.schema import SCHEMAS


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(amount):
    return None if amount is None else Decimal(str(amount))


def line(id, enrolment, concept, amount, owed, number=1):
    return (id, enrolment, number, concept, money(amount), money(owed))


def payment(instalment, receipt, when, active=1):
    return (instalment, receipt, at(when), active)


def enrolment(id, program=1, student=10, adviser=20, plan=1, state=1):
    return (id, program, student, adviser, plan, state, at("2026-01-01"))


DEFAULTS = {
    "inscripciones": [enrolment(100)],
    "programas": [(1, "PRG-1", "Programa uno", 1, 49, 9)],
    "postgrados": [(1, 8)],
    "categorias": [(8, "Categoria 8")],
    "plan_cobros_programa": [(1, "Plan Contado"), (2, "Plan Credito"), (3, None)],
    "plan_pagos": [],
    "detalle_pagos_inscripcion": [],
    "pagos_inscripcion": [(1, 501, 1), (2, 502, 0), (3, 503, 1)],
    "personas": [
        (10, "Ana", "Rojas", None, "CI10"),
        (20, "Luis", "", "Paz", "CI20"),
        (21, "Eva", None, None, "CI21"),
    ],
    "sedes": [(49, "SEDE 49", 1), (1, "SEDE 1", None), (39, "SEDE 39", 1), (11, "SEDE 11", 1)],
    "unidad_negocio": [(1, "UNIDAD 1")],
    "instituciones": [(9, "INST-A"), (49, None), (301, "INST-C")],
}


def tables(spark, **changed):
    rows = {**DEFAULTS, **changed}
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}
