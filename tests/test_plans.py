"""Physical plans: exchanges, pruning, no Python in the hot path."""

from __future__ import annotations

from dataclasses import replace

from tape_audit.config import Policy
from tape_audit.plans import driver_tables as DT
from tape_audit.plans import features as X
from tape_audit.plans.ledger import build_ledger

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nested_tape_needs_one_exchange(spark):
    led = build_ledger(DT.raw_tape(spark, SF), Policy(as_of=DT.TAPE_AS_OF))
    plan = plan_of(led.prepared().payments)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_measures_stay_on_the_same_partitioning(spark):
    led = build_ledger(DT.raw_tape(spark, SF), Policy(as_of=DT.TAPE_AS_OF)).prepared()
    plan = plan_of(X.loan_measures(led.payments, Policy(), led.as_of))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_detail_scan_is_pruned(spark):
    led = replace(DT.order_ledger(spark, SF))
    plan = plan_of(led.payments.select("source_row_index", "amount"))
    assert "l_shipdate" not in plan and "l_tax" not in plan
