from collections import defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from enrolmeter.operators.balances import (
    Balance,
    balance_by_value,
    balance_totals,
    enrolment_balances,
    paid_lines,
    payments_info,
)

from .tiny import at, line, money, payment, tables


def rows_of(df):
    return [row.asDict() for row in df.collect()]


def test_raw_repeats_the_amount_per_active_payment_and_dedup_does_not(spark):
    t = tables(
        spark,
        plan_pagos=[line(1, 100, 18, 50, 0), line(2, 100, 18, 70, 70)],
        detalle_pagos_inscripcion=[
            payment(1, 1, "2026-01-05"),
            payment(1, 3, "2026-01-07"),
            payment(1, 1, "2026-01-09", active=0),
        ],
    )
    (raw,) = rows_of(enrolment_balances(t, Balance("b", (18,), payments="raw")))
    (dedup,) = rows_of(enrolment_balances(t, Balance("b", (18,))))
    assert (raw["b_monto"], raw["b_saldo"], raw["b_cancelado"]) == (170, 70, 100)
    assert (dedup["b_monto"], dedup["b_saldo"], dedup["b_cancelado"]) == (120, 70, 50)
    assert raw["b_fecha"] == dedup["b_fecha"] == at("2026-01-07")


def test_voided_receipt_keeps_the_date_in_raw_only(spark):
    t = tables(
        spark,
        plan_pagos=[line(1, 100, 18, 50, 0)],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-01-05"), payment(1, 2, "2026-02-05")],
    )
    (raw,) = rows_of(enrolment_balances(t, Balance("b", (18,), payments="raw"), receipt=True))
    (dedup,) = rows_of(enrolment_balances(t, Balance("b", (18,)), receipt=True))
    assert (raw["b_fecha"], raw["b_recibo"]) == (at("2026-02-05"), 501)
    assert (dedup["b_fecha"], dedup["b_recibo"]) == (at("2026-01-05"), 501)


def test_unknown_outstanding_amount_counts_in_monto_only(spark):
    t = tables(spark, plan_pagos=[line(1, 100, 18, 50, None), line(2, 100, 18, 70, 20)])
    (row,) = rows_of(enrolment_balances(t, Balance("b", (18,))))
    assert (row["b_monto"], row["b_cancelado"], row["b_saldo"]) == (120, 50, 20)
    assert row["b_fecha"] is None


def test_only_the_first_instalment_of_the_concept(spark):
    t = tables(
        spark,
        plan_pagos=[line(1, 100, 8, 5, 0), line(2, 100, 8, 6, 0, number=2), line(3, 100, 17, 9, 0)],
    )
    first = Balance("first", (8,), first_only=True)
    both = Balance("both", (8, 17))
    (row,) = rows_of(enrolment_balances(t, first, both))
    assert (row["first_monto"], row["both_monto"]) == (5, 20)


def test_by_value_merges_equal_and_keeps_unlike_first_instalments(spark):
    t = tables(
        spark,
        plan_pagos=[
            line(1, 100, 2, 50, 0), line(2, 100, 2, 50, 0), line(3, 100, 2, 60, 0),
            line(4, 100, 2, 60, None), line(5, 100, 2, 60, None), line(6, 100, 1, 10, 0),
        ],
        detalle_pagos_inscripcion=[payment(1, 1, "2026-01-05"), payment(2, 2, "2026-01-06")],
    )
    b = Balance("b", (2,), first_only=True, payments="raw")
    found = {
        (r["b_monto"], r["b_saldo"]): r["b_fecha"]
        for r in rows_of(balance_by_value(paid_lines(t, (b,)), b))
    }
    assert found == {(50, 0): at("2026-01-06"), (60, 0): None, (60, None): None}


def test_a_report_counts_payments_one_way(spark):
    with pytest.raises(ValueError):
        enrolment_balances(tables(spark), Balance("a"), Balance("b", payments="raw"))
    with pytest.raises(ValueError):
        Balance("a", payments="sometimes")


def test_invariants_on_given_data(small_tables):
    t = small_tables
    info = payments_info(t["detalle_pagos_inscripcion"], t["pagos_inscripcion"])
    assert info.groupBy("cuota_id").count().where("count > 1").isEmpty()

    raw, dedup = Balance("raw", payments="raw"), Balance("dedup")
    both = enrolment_balances(t, raw).join(enrolment_balances(t, dedup), "inscripcion_id", "full")
    assert both.groupBy("inscripcion_id").count().where("count > 1").isEmpty()
    assert both.where("raw_monto < dedup_monto OR raw_monto IS NULL").isEmpty()
    assert not both.where("raw_monto > dedup_monto").isEmpty()

    known = t["plan_pagos"].where(F.col("saldo").isNotNull())
    totals = balance_totals(known, (Balance("p", payments="none"),))
    assert totals.where("p_cancelado + p_saldo <> p_monto").isEmpty()


# --- one-pass form against the payment rows joined and summed in plain Python ---------------

_lines = st.lists(
    st.tuples(
        st.integers(1, 3),  # enrolment
        st.sampled_from([2, 18]),  # concept
        st.integers(0, 5),  # amount
        st.one_of(st.none(), st.integers(0, 5)),  # outstanding
        st.integers(1, 2),  # instalment number
    ),
    max_size=6,
)
_payments = st.lists(
    st.tuples(st.integers(0, 6), st.integers(1, 4), st.integers(1, 28), st.integers(0, 1)),
    max_size=12,
)


def brute_force(lines, payments, receipts, balance):
    """Join row by row, then sum: the fan-out as it happens, no reduction beforehand."""
    joined = defaultdict(list)
    for id, enrolment, number, concept, amount, owed in lines:
        if concept not in balance.concepts or (balance.first_only and number != 1):
            continue
        paid = [p for p in payments if p[0] == id and p[3] == 1]
        if balance.payments == "dedup":
            paid = [p for p in paid if receipts.get(p[1]) == 1]
            paid = [max(paid, key=lambda p: p[2])] if paid else []
        for p in paid or [None]:
            joined[enrolment].append((amount, owed, p and p[2]))

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known, Decimal(0)) if known else None

    return {
        enrolment: (
            total(a for a, _, _ in rows),
            total(None if o is None else a - o for a, o, _ in rows),
            total(o for _, o, _ in rows),
            max((d for _, _, d in rows if d), default=None),
        )
        for enrolment, rows in joined.items()
    }


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(_lines, _payments, st.sampled_from(["raw", "dedup"]), st.booleans())
def test_balances_equal_brute_force(spark, lines, payments, mode, first_only):
    plan = [
        (i, enrolment, number, concept, money(amount), money(owed))
        for i, (enrolment, concept, amount, owed, number) in enumerate(lines)
    ]
    details = [payment(i, r, f"2026-01-{day:02d}", active) for i, r, day, active in payments]
    receipts = [(1, 501, 1), (2, 502, 0), (3, 503, 1)]
    t = tables(
        spark,
        plan_pagos=plan,
        detalle_pagos_inscripcion=details,
        pagos_inscripcion=receipts,
    )
    b = Balance("b", (18,), first_only=first_only, payments=mode)
    expected = brute_force(plan, details, {r[0]: r[2] for r in receipts}, b)
    actual = {
        r["inscripcion_id"]: (r["b_monto"], r["b_cancelado"], r["b_saldo"], r["b_fecha"])
        for r in rows_of(enrolment_balances(t, b))
    }
    assert actual == expected
