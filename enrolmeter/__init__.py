"""Enrolment reports as Spark DataFrames."""

from .plans.report import run as report
from .sources import catalog_tables, jdbc_tables, load_tables
from .specs import UNITS, UnitSpec, deduplicated

__all__ = [
    "UNITS", "UnitSpec", "catalog_tables", "deduplicated", "jdbc_tables", "load_tables", "report",
]
