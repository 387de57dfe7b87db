"""Balances: instalments and their payments reduced to amounts per enrolment.

Grain matters here. Partial payments make several payment rows per instalment, so a plain
join of the two repeats the instalment's amount. Every payment table is therefore reduced
to one row per instalment *before* it meets the plan, in both payment modes:

``dedup``  a payment counts if it and its receipt are active; the amount counts once.
``raw``    an active payment counts whatever its receipt; the amount counts once per
           active payment (and once if there is none). That repetition is kept as a
           number, ``n_pagos``, and multiplied in, so nothing fans out.
``none``   payments are not looked at.

Reducing first also means a map-side combine ahead of every shuffle: an instalment that
holds a third of all payments arrives as one row per task, not as a hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schema import TOTAL
from ..sources.tables import Tables
from .star import one_of

ENROLMENT = "inscripcion_id"


@dataclass(frozen=True)
class Balance:
    """Which plan lines make up a balance, and how their payments count."""

    name: str
    concepts: tuple[int, ...] | None = None  # None: the whole plan
    first_only: bool = False  # only the first instalment of each concept
    payments: str = "dedup"  # dedup | raw | none

    def __post_init__(self):
        if self.payments not in ("dedup", "raw", "none"):
            raise ValueError(f"unknown payment mode {self.payments!r}")
        if self.concepts is not None and not self.concepts:
            raise ValueError(f"balance {self.name!r} has no concepts: None stands for all")

    def covers(self) -> Column | None:
        """Test for the plan lines this balance takes; None takes them all."""
        tests = []
        if self.concepts is not None:
            tests.append(one_of("concepto_pago_id", self.concepts))
        if self.first_only:
            tests.append(F.col("nro_cuota") == 1)
        return reduce(Column.__and__, tests) if tests else None


# --- payments, one row per instalment ------------------------------------------------------


def _active_payments(details: DataFrame) -> DataFrame:
    return details.where(F.col("estado") == 1).drop("estado")


def _active_receipts(receipts: DataFrame) -> DataFrame:
    return receipts.where(F.col("estado") == 1).select(
        F.col("id").alias("pagos_inscripcion_id"), "nro_recibo"
    )


def payments_info(details: DataFrame, receipts: DataFrame) -> DataFrame:
    """Latest payment and highest receipt per instalment; payments of voided receipts drop.

    The receipt join is inner, so adaptive execution may split a hot receipt on either
    side; the grouping above it combines per task before it shuffles.
    """
    return (
        _active_payments(details)
        .join(_active_receipts(receipts), "pagos_inscripcion_id")
        .groupBy("cuota_id")
        .agg(
            F.max("fecha_registro_pago").alias("fecha_pago"),
            F.max("nro_recibo").alias("nro_recibo"),
        )
    )


def payment_counts(details: DataFrame, receipts: DataFrame | None = None) -> DataFrame:
    """Number of active payments and the latest one per instalment, voided receipts included.

    Receipts are joined only if given, and then only add ``nro_recibo`` (of active
    receipts): their id is unique, so they change neither counts nor dates.
    """
    paid = _active_payments(details)
    measures = [
        F.count(F.lit(1)).alias("n_pagos"),
        F.max("fecha_registro_pago").alias("fecha_pago"),
    ]
    if receipts is not None:
        paid = paid.join(_active_receipts(receipts), "pagos_inscripcion_id", "left")
        measures.append(F.max("nro_recibo").alias("nro_recibo"))
    return paid.groupBy("cuota_id").agg(*measures)


# --- plan lines ---------------------------------------------------------------------------


def lines_of(plan: DataFrame, balances: Sequence[Balance]) -> DataFrame:
    """Plan lines at least one of the balances takes (the test reaches the scan)."""
    tests = [b.covers() for b in balances]
    if any(t is None for t in tests):
        return plan
    return plan.where(reduce(Column.__or__, tests))


def attach_payments(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """Plan lines with their reduced payments, one to one; unpaid lines stay."""
    return lines.join(payments.withColumnRenamed("cuota_id", "id"), "id", "left")


# --- balances -----------------------------------------------------------------------------


def balance_totals(
    lines: DataFrame,
    balances: Sequence[Balance],
    keys: Sequence[str] = (ENROLMENT,),
    receipt: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """All balances of an enrolment in one grouping: one scan and one shuffle for any number.

    Gives ``<name>_monto``, ``_cancelado``, ``_saldo`` and, where payments count, ``_fecha``
    (and ``_recibo`` on request). A balance with no line is NULL throughout. Lines with an
    unknown outstanding amount add to ``monto`` only.
    """
    measures: list[Column] = []
    for b in balances:
        measures += _measures(b, receipt)
    return lines.groupBy(*keys).agg(*measures, *extra)


def _measures(b: Balance, receipt: bool) -> list[Column]:
    covers = b.covers()

    def taken(value: Column) -> Column:
        return value if covers is None else F.when(covers, value)

    def total(amount: Column, suffix: str) -> Column:
        if b.payments == "raw":
            amount = amount * F.coalesce(F.col("n_pagos"), F.lit(1))
        return F.sum(taken(amount)).cast(TOTAL).alias(f"{b.name}_{suffix}")

    agreed, outstanding = F.col("monto"), F.col("saldo")
    out = [
        total(agreed, "monto"),
        total(agreed - outstanding, "cancelado"),
        total(outstanding, "saldo"),
    ]
    if b.payments != "none":
        out.append(F.max(taken(F.col("fecha_pago"))).alias(f"{b.name}_fecha"))
        if receipt:
            out.append(F.max(taken(F.col("nro_recibo"))).alias(f"{b.name}_recibo"))
    return out


def balance_by_value(
    lines: DataFrame,
    balance: Balance,
    keys: Sequence[str] = (ENROLMENT,),
    receipt: bool = False,
) -> DataFrame:
    """One row per enrolment and distinct (agreed, outstanding) pair; nothing is summed.

    Unlike first instalments give an enrolment several rows, equal ones collapse.
    """
    covers = balance.covers()
    taken = lines if covers is None else lines.where(covers)
    latest = [F.max("fecha_pago").alias(f"{balance.name}_fecha")]
    if receipt:
        latest.append(F.max("nro_recibo").alias(f"{balance.name}_recibo"))
    return (
        taken.groupBy(*keys, "monto", "saldo")
        .agg(*latest)
        .withColumn(f"{balance.name}_monto", F.col("monto").cast(TOTAL))
        .withColumn(f"{balance.name}_saldo", F.col("saldo").cast(TOTAL))
        .drop("monto", "saldo")
    )


VALUE = ("value_monto", "value_saldo")


def valued_totals(
    lines: DataFrame, balances: Sequence[Balance], by_value: Balance, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """All balances per key, and the by-value balance's rows, from one grouping of the lines.

    Keys that have lines in the by-value balance alone count as keys with lines.
    Lines are grouped by key and value (NULL where ``by_value`` does not take the line); every
    measure is a sum or a maximum, so grouping those rows by key alone gives the totals. The second
    table has its keys and the totals' names with the prefix ``own_``, so that a caller who reads
    both keeps them from being pruned: only equal plans share one scan and one shuffle.
    """
    covers = by_value.covers()
    taken = F.lit(True) if covers is None else F.coalesce(covers, F.lit(False))
    latest = [m for m in _measures(by_value, receipt=False) if by_value.payments != "none"][3:]
    measures = [m for b in balances for m in _measures(b, receipt=False)]
    valued = lines.select(
        "*", F.when(taken, F.col("monto")).alias(VALUE[0]), F.when(taken, F.col("saldo")).alias(VALUE[1])
    )
    groups = valued.groupBy(*keys, *VALUE).agg(
        *measures, *latest,
        F.max(taken.cast("int")).alias("has_values"),
    )
    of_values = {f"{by_value.name}_fecha"} if latest else set()
    names = [c for c in groups.columns if c not in {*keys, *VALUE, *of_values}]

    def whole(name: str) -> Column:
        if name.endswith(("_monto", "_cancelado", "_saldo")):
            return F.sum(name).cast(TOTAL).alias(name)
        return F.max(name).alias(name)

    # The latest payments of values belong to these; their maximum is asked for to keep both plans equal.
    totals = groups.groupBy(*keys).agg(
        *map(whole, names), *(F.max(c).alias(f"any_{c}") for c in sorted(of_values))
    )
    values = groups.where(F.col("has_values") == 1).select(
        *keys,
        *(F.col(c).alias(f"own_{c}") for c in names),
        *sorted(of_values),
        *(F.col(v).cast(TOTAL).alias(f"{by_value.name}_{m}") for v, m in zip(VALUE, ("monto", "saldo"))),
    )
    return totals, values


def reduced_payments(
    tables: Tables, balances: Sequence[Balance], receipt: bool = False
) -> DataFrame | None:
    """The payment side the balances ask for, or None if they ask for none."""
    modes = {b.payments for b in balances} - {"none"}
    if not modes:
        return None
    if len(modes) > 1:
        raise ValueError("balances of one report must count payments the same way")
    details, receipts = tables["detalle_pagos_inscripcion"], tables["pagos_inscripcion"]
    if modes == {"dedup"}:
        return payments_info(details, receipts)
    return payment_counts(details, receipts if receipt else None)


def paid_lines(
    tables: Tables, balances: Sequence[Balance], lines: DataFrame | None = None, receipt: bool = False
) -> DataFrame:
    """Lines the balances take, each with its reduced payments where they count.

    ``lines`` narrows the plan beforehand (say, to a report's enrolments).
    """
    taken = lines_of(tables["plan_pagos"] if lines is None else lines, balances)
    payments = reduced_payments(tables, balances, receipt)
    return taken if payments is None else attach_payments(taken, payments)


def enrolment_balances(tables: Tables, *balances: Balance, receipt: bool = False) -> DataFrame:
    """Balances of every enrolment that has a line in one of them."""
    return balance_totals(paid_lines(tables, balances, receipt=receipt), balances, receipt=receipt)
