"""A ledger without a giant loan is dealt by loan once; the other path gives the same, and results hold what is asked for."""

from __future__ import annotations

import pytest

from tape_audit.config import Policy
from tape_audit.operators.staging import drop_tables, staged_tables
from tape_audit.plans import driver_tables as DT
from tape_audit.plans import features as X
from tape_audit.plans import queries as Q
from tape_audit.plans.audit import assess_ledger, verdicts
from tape_audit.plans.ledger import build_ledger
from tape_audit.session import spread
from tests.test_plans import plan_of

SF = "/root/testdata/sf0.001"


def test_stored_payments_are_not_exchanged_by_loan(spark):
    led = DT.order_ledger(spark, SF).staged()
    assert not led.giant_loans
    for df in (X.loan_measures(led.payments, Policy(), led.as_of), X.calendar_measures(led.payments, Policy(), led.as_of)):
        assert "Exchange" not in plan_of(df)
    path = staged_tables(spark)[-1]
    drop_tables(spark, [path])
    assert path not in staged_tables(spark) and not spark.catalog.tableExists(path.rsplit("/", 1)[1])


def test_an_order_beyond_the_limit_takes_the_other_path(spark, monkeypatch):
    plain = sorted(map(tuple, Q.QUERIES["lateness_bands"](spark, SF).collect()), key=str)
    monkeypatch.setattr(DT, "ORDINARY_ROWS", 3)
    assert DT.order_ledger(spark, SF).giant_loans
    assert sorted(map(tuple, Q.QUERIES["lateness_bands"](spark, SF).collect()), key=str) == plain


@pytest.mark.parametrize("names", [("verdict", "tier", "rule_ids", "outcomes")])
def test_results_without_texts_are_the_same(spark, names):
    led, assessed = assess_ledger(DT.order_ledger(spark, SF), Policy())
    lean, full = verdicts(assessed, led, told=False), verdicts(assessed, led)
    assert set(full.columns) - set(lean.columns) == {"primary_reason", "all_reasons", "residuals"}
    a, b = lean.select("source_row_index", *names), full.select("source_row_index", *names)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert "message" not in plan_of(Q.judged(spark, SF, "verdict")[1])


def test_stored_cells_are_decoded_by_many_tasks(spark):
    seen = []
    build_ledger(DT.raw_tape(spark, SF), Q.TAPE_POLICY, stager=lambda t: seen.append(t) or t)
    assert seen[0].rdd.getNumPartitions() == spread(spark) > 1
    assert len(Q.staged_tape(spark, SF).inputFiles()) == spread(spark)


def test_interest_is_exchanged_once_beside_the_loans(spark):
    """Reductions and probes of the days are united and dealt by loan again; nothing after that moves."""
    led = DT.order_ledger(spark, SF).staged()
    plan = plan_of(X.interest_accrual(led, Policy()))
    assert plan.count("Exchange hashpartitioning") - plan.count("REPARTITION_BY_NUM") == 0
