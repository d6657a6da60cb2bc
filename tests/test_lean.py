"""Verdicts without texts make only the features they read, payments are added up once for a feature, and results stay."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tape_audit.config import Policy
from tape_audit.plans import driver_tables as DT
from tape_audit.plans import features as X
from tape_audit.plans import rules
from tape_audit.plans.audit import assess_ledger, verdicts
from tape_audit.sources import sinks
from tests.test_plans import plan_of

LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


@pytest.fixture
def tables(spark, tmp_path):
    """Orders with all kinds of lines, one without lines, one line that comes three times, one that lacks its price."""
    orders = [(k, k * 3, "FOP"[k % 3], 1000.0 + 700 * k, "5-LOW" if k % 2 else "1-URGENT") for k in range(1, 120)]
    lines = [(k, n, 1 + k * 37 + n * 11, 1 + k * 13 + n, 100.0 * n + k, "RNA"[(k + n) % 3], "F" if (k + n) % 4 else "O")
             for k in range(2, 120) for n in range(1, 2 + k % 7)]
    lines += [lines[3]] * 2 + [(5, 9, 6, 7, None, "R", "F")]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_verdicts_do_without_what_only_texts_show(spark, tables):
    led, full = assess_ledger(DT.order_ledger(spark, tables), Policy())
    lean = assess_ledger(DT.order_ledger(spark, tables), Policy(), told=False)[1]
    assert not {"median_delay_days", "usual_due_day", *rules.TOLD_COLUMNS} & set(lean.columns)
    a, b = verdicts(full, led, told=False), verdicts(lean, led, told=False)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    told = verdicts(full, led).select("source_row_index", "verdict", "rule_ids", "root_axes", "finding_groups", "root_count", "severity_rank")
    assert told.exceptAll(b.select(*told.columns)).isEmpty()
    assert sorted(r["source_row_index"] for r in b.collect()) == list(range(1, 120))


def test_summary_is_that_of_the_findings(spark, tables):
    led, lean = assess_ledger(DT.order_ledger(spark, tables), Policy(), told=False)
    for r in verdicts(lean, led, told=False).collect():
        found = r["findings"]
        reported = [f for f in found if f["rank"] > 0]
        roots = [f for f in reported if f["root_cause"]]
        leads = roots or reported
        assert r["rule_ids"] == ";".join(f["rule_id"] for f in found) and r["finding_count"] == len(found)
        assert (r["reported_count"], r["root_count"]) == (len(reported), len(roots))
        assert r["root_axes"] == "+".join(sorted({f["axis"] for f in roots}))
        assert r["finding_groups"] == ";".join(sorted({f["group"] for f in found if f["group"]}))
        assert r["severity_rank"] == max((f["rank"] for f in leads), default=0)
        names = {f["rule_id"] for f in found}
        for f in found:
            causes = [s for s in rules.BY_ID[f["rule_id"]].subsumed_by if s in names]
            assert f["symptom_of"] in (None, *causes[:1]) and f["root_cause"] == (f["symptom_of"] is None)


def test_rates_add_up_the_payments_once_for_their_candidates(spark, tables):
    led = DT.order_ledger(spark, tables).staged()
    candidates = X.rate_candidates(led, Policy())
    again = plan_of(candidates).count("FileScan")
    assert again > 1  # payments, loans and their counts
    assert plan_of(X.realised_rates(led, candidates, Policy())).count("FileScan") < 2 * again


def test_balances_of_days_are_those_of_reductions_and_probes(spark):
    big = 9_000_000_000_000_000_000
    day = [date(2020, 1, d) for d in range(1, 32)]
    rows = [("t", 1, True, False, 50.0, 50, 0, day[1], day[0], True, 1), ("t", 1, True, False, 0.0, 0, 7, None, day[2], False, 2),
            ("t", 1, False, False, 9.0, 9, 9, day[3], day[2], True, 1), ("t", 1, False, True, 5.0, 5, 0, day[2], None, False, 1),
            ("t", 1, False, False, 0.0, 0, 0, None, day[5], True, 1), ("t", 2, True, False, 1.0, big, 0, day[1], day[1], True, 3),
            ("t", 2, False, False, 0.0, 0, 0, None, day[4], True, 1), ("t", 3, None, None, 1.0, 3, 3, day[1], day[1], None, 1),
            ("t", 3, False, False, 0.0, 0, 0, None, day[0], True, 1), ("t", None, True, False, 1.0, 4, 0, day[0], day[6], True, 1)]
    payments = spark.createDataFrame(rows, "tape_id string, source_row_index long, is_schedule_row boolean, is_settlement_cash boolean, paid_eur double,"
                                           "paid_micros long, exposure_micros long, actual_date date, due_date date, probe boolean, copies long")
    probes = payments.filter("probe and due_date is not null").select(*X.KEY, F.col("due_date").alias("day")).distinct()
    want = X.reduced_before(X.daily_reductions(payments), probes)
    got = X._balance_days(payments, F.coalesce("probe", F.lit(False)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert len(want.collect()) == 7


def test_summary_of_results_without_texts(spark):
    names = ("tape_id", "loan_id", "source_row_index", "verdict", "tier", "severity", "data_integrity", "credit_event", "validation_coverage",
             "loan_status", "finding_count", "finding_groups", "rule_ids", "checks_passed", "checks_failed", "checks_not_evaluable")
    whole = {"source_row_index": 1, "finding_count": 0, "checks_passed": 50, "checks_failed": 0, "checks_not_evaluable": 0, "loan_id": 7}
    results = spark.range(1).select(*[F.lit(whole.get(n, "x")).alias(n) for n in names])
    unread = spark.createDataFrame([("t", 2, "N/A")], "tape_id string, source_row_index int, loan_id_raw string")
    out = sinks.summary_table(results, unread)
    assert "primary_reason" not in out.columns
    assert sorted((r["source_row_index"], r["rule_ids"]) for r in out.collect()) == [(1, "x"), (2, "A1")]
    told = results.withColumns({"primary_reason": F.lit("p"), "all_reasons": F.lit("a")})
    assert sinks.summary_table(told, unread).columns[13:15] == ["primary_reason", "all_reasons"]
