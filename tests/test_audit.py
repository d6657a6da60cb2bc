"""One tape with clean loans and one planted fault per loan, audited once, then published twice."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from tape_audit.config import Policy
from tape_audit.plans.ledger import TapeRefusedError, check_schema
from tape_audit.sources import reader
from tape_audit.streaming.onboard import audit_batch

AS_OF = dt.date(2024, 12, 31)


def add_months(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    return dt.date(d.year + m // 12, m % 12 + 1, d.day)


def clean_loan(loan_id: int, paid: int = 12) -> dict:
    """1,200 euros at 12 % over 12 equal principal parts, ``paid`` of them paid on the due date."""
    start, rows = dt.date(2023, 6, 10), []
    for i in range(12):
        due = add_months(start, i + 1)
        for kind, amount in (("principal", 100.0), ("interest", round((1200 - 100 * i) * 0.01, 2))):
            rows.append({
                "Loan ID": str(loan_id), "Payment date": due.strftime("%d/%m/%Y"),
                "Repayment date": due.strftime("%d/%m/%Y") if i < paid else None, "Type": kind,
                "State": "paid on time" if i < paid else "pending", "Amount": amount,
                "Pending amount": 0.0 if i < paid else amount})
    interest = [round((1200 - 100 * i) * 0.01, 2) for i in range(12)]
    return {
        "Loan ID": str(loan_id), "Borrower ID": str(loan_id + 5000), "Loan amount": "1200", "Disbursal date": "2023-06-10",
        "Interest rate": "12.0", "Loan term": "12", "Loan status": "repaid", "payments": rows,
        "Expected repayment date": "2024-06-10", "Loan type": "instalment", "Borrower type": "individual",
        "Credit score": "B", "Monthly payment": "112.00", "Days late": "0", "Outstanding principal": "0.0",
        "Repaid principal": "1200.0", "Outstanding interest": "0.0", "Repaid interest": str(sum(interest)),
        "Repayment date": "2024-06-10", "Arrears": "0", "Delay interest": "0.0", "Purpose": "refinancing",
        "Birth year": "1985.0", "Family income": "2500", "Borrower income": "2000", "Family liabilities": "0",
        "Children": "1", "Employment status": "employed", "Company age (years)": None,
    }


def shift(row: dict, days: int) -> None:
    due = dt.datetime.strptime(row["Payment date"], "%d/%m/%Y") + dt.timedelta(days=days)
    row.update({"Repayment date": due.strftime("%d/%m/%Y"), "State": "paid with delay" if days > 5 else "paid on time"})


def faults() -> list[tuple[dict, set[str]]]:
    """(loan, rules that must fire); an empty set means nothing may fire."""
    out: list[tuple[dict, set[str]]] = [(clean_loan(1), set())]

    def case(rules: set[str], change) -> None:
        loan = clean_loan(len(out) + 1)
        change(loan, loan["payments"])
        out.append((loan, rules))

    case({"A2"}, lambda l, p: l.update({"Borrower ID": " None "}))
    case({"A3"}, lambda l, p: l.update({"Arrears": "1,234"}))
    case({"A4"}, lambda l, p: l.update({"Repayment date": "31/31/2024"}))
    case({"A5"}, lambda l, p: p[0].update({"Payment date": "2023-07-10"}))
    case({"A6"}, lambda l, p: l.update({"Credit score": "Z"}))
    case({"A6"}, lambda l, p: l.update({"Purpose": "loan_purpose.7"}))
    case({"A7"}, lambda l, p: l.update({"payments": "garbage"}))
    case({"A7"}, lambda l, p: l.update({"payments": "[]"}))
    case({"A9"}, lambda l, p: p[0].update({"Bonus": 1}))
    case({"A10"}, lambda l, p: p[0].update({"Loan ID": "999"}))
    case({"B1", "B3"}, lambda l, p: p[0].update({"Amount": 150.0}))
    case({"B2"}, lambda l, p: l.update({"Outstanding principal": "0.6"}))
    case({"B4"}, lambda l, p: l.update({"Repaid interest": "10"}))
    case({"B5"}, lambda l, p: l.update({"Outstanding interest": "5"}))
    case({"B6"}, lambda l, p: l.update({"Delay interest": "5"}))
    case({"B7"}, lambda l, p: l.update({"Days late": "6"}))
    case({"B11"}, lambda l, p: l.update({"Expected repayment date": "2024-10-10"}))
    case({"C4"}, lambda l, p: l.update({"Arrears": "-1"}))
    case({"C5", "C6"}, lambda l, p: p[0].update({"Pending amount": 101.0}))
    case({"C9"}, lambda l, p: p.append(dict(p[0])))
    case({"C10"}, lambda l, p: p.append({**p[0], "Amount": 100.01}))
    case({"D1"}, lambda l, p: l.update({"Disbursal date": "2023-07-11"}))
    case({"D2"}, lambda l, p: shift(p[22], 300))
    case({"D5"}, lambda l, p: l.update({"Repayment date": "2023-01-01"}))
    case({"D7"}, lambda l, p: shift(p[4], -9))
    case({"D8"}, lambda l, p: (shift(p[4], 7), p[4].update({"State": "paid on time"})))
    case({"E1"}, lambda l, p: l.update({"Repayment date": None}))
    case({"E2"}, lambda l, p: l.update({"Loan status": "granted"}))
    case({"E3"}, lambda l, p: l.update({"Loan status": "terminated"}))
    case({"E4"}, lambda l, p: p[0].update({"Repayment date": None}))
    case({"F1"}, lambda l, p: shift(p[4], 90))
    case({"F3"}, lambda l, p: shift(p[4], 89))
    case({"F2", "E1"}, lambda l, p: p[22].update({"Repayment date": None, "State": "pending late", "Pending amount": 100.0}))
    case({"G6"}, lambda l, p: [shift(r, 10) for r in p])
    case({"G8"}, lambda l, p: [shift(r, 9) for r in p[18:]])
    case({"H1"}, lambda l, p: l.update({"Birth year": "1900"}))
    case({"H3"}, lambda l, p: l.update({"Monthly payment": "2500.01"}))
    case({"H4"}, lambda l, p: l.update({"Birth year": None}))
    case({"H5"}, lambda l, p: l.update({"Loan term": "400"}))
    case({"H9"}, lambda l, p: l.update({"Children": "-1"}))
    case({"H10"}, lambda l, p: l.update({"Employment status": "Unemployed"}))
    return out


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tape")
    cases = faults()
    loans = [c[0] for c in cases] + [{**clean_loan(900), "Loan ID": "N/A"}]
    path = base / "tape.jsonl"
    with open(path, "w", encoding="utf-8") as fh:
        for loan in loans:
            cell = loan["payments"]
            fh.write(json.dumps({**loan, "payments": cell if isinstance(cell, str) else repr(cell)}) + "\n")
    rows = reader.read_tape(spark, str(path))
    policy, folder = Policy(as_of=AS_OF), str(base / "out")
    first = audit_batch(rows, folder, policy)
    again = audit_batch(rows, folder, policy)
    return cases, folder, first, again


def test_clean_loan_and_planted_faults(spark, published):
    cases, folder, _, _ = published
    got = {r.loan_id: r for r in spark.read.parquet(f"{folder}/loan_results").collect()}
    for loan, expected in cases:
        r = got[int(loan["Loan ID"])]
        fired = set(filter(None, r.rule_ids.split(";")))
        assert expected <= fired, (loan["Loan ID"], expected, fired)
        if not expected:
            assert not fired and r.verdict == "normal" and r.tier == "clean" and r.checks_passed > 20
            assert r.primary_reason == "every check that applies was passed"


def test_default_boundary_and_severity(spark, published):
    cases, folder, _, _ = published
    by = {tuple(sorted(e)): int(loan["Loan ID"]) for loan, e in cases}
    got = {r.loan_id: r for r in spark.read.parquet(f"{folder}/loan_results").collect()}
    assert got[by[("F1",)]].credit_event == "default" and got[by[("F3",)]].credit_event == "watch"
    assert got[by[("E1", "F2")]].severity == "critical"
    assert got[by[("B1", "B3")]].rule_ids.split(";")[:2] == ["B1", "B3"]


def test_publication_is_idempotent_and_accounts_for_every_row(spark, published):
    cases, folder, first, again = published
    assert first and again is None
    run = spark.read.parquet(f"{folder}/run").collect()
    assert len(run) == 1 and run[0].rows_read == len(cases) + 1 and run[0].unaccounted == 0
    assert run[0].publication_status == "review_required"
    summary = spark.read.parquet(f"{folder}/summary")
    assert summary.count() == len(cases) + 1
    assert summary.filter("verdict = 'unreadable' AND rule_ids = 'A1' AND loan_id = '[unavailable]'").count() == 1


def test_tables_are_consistent(spark, published):
    cases, folder, _, _ = published
    payments = spark.read.parquet(f"{folder}/payments")
    coverage = spark.read.parquet(f"{folder}/coverage")
    assert coverage.count() == len(cases) and len(coverage.columns) == 61
    assert payments.groupBy("tape_id", "source_row_index", "payment_seq").count().filter("count > 1").isEmpty()
    assert payments.count() == coverage.agg({"records_parsed": "sum"}).first()[0]
    one = payments.filter("loan_id = 1 AND type = 'interest'").orderBy("payment_seq").collect()
    assert [round(r.implied_annual_rate_pct, 2) for r in one] == [12.0] * 12
    assert spark.read.parquet(f"{folder}/rule_outcomes").count() == 50 * len(cases)
    assert {r.rule_id for r in spark.read.parquet(f"{folder}/tape_checks").collect()} == {f"I{i}" for i in range(1, 7)}
    health = {(r.metric, r.column): r.value for r in spark.read.parquet(f"{folder}/health").collect()}
    assert health[("rows", "")] == str(len(cases) + 1) and health[("outside_dictionary", "Credit score")] == "1"
    leaked = spark.read.parquet(f"{folder}/findings").filter("rule_id = 'A10' AND message LIKE '%999%'")
    assert leaked.isEmpty()


def test_schema_faults_reject(spark, tmp_path):
    bad = tmp_path / "t.csv"
    bad.write_text("Loan ID, Loan ID,x\n1,2,3\n")
    with pytest.raises(TapeRefusedError):
        reader.read_tape(spark, str(bad))
    empty = tmp_path / "e.csv"
    empty.write_text("Loan ID,x\n")
    with pytest.raises(reader.SourceError):
        reader.read_tape(spark, str(empty))
    with pytest.raises(reader.SourceError):
        reader.format_of("tape.xlsx")
    good = tmp_path / "g.csv"
    good.write_text(' Loan ID ,,note\n1,x,"two\nlines"\n2,y,NA\n')
    df = reader.read_tape(spark, str(good))
    assert df.columns == ["Loan ID", "note"] and df.count() == 2
    assert {r.note for r in df.collect()} == {"two\nlines", "NA"}
    assert not check_schema(["Loan ID"]).ok


def test_second_tape_leaves_the_first_alone(spark, published, tmp_path):
    cases, folder, first, _ = published
    names = sorted(os.listdir(folder))
    before = {n: {t: sorted(map(str, spark.read.parquet(f"{folder}/{n}/{t}").collect())) for t in os.listdir(f"{folder}/{n}") if t.startswith("tape=")} for n in names}
    path = tmp_path / "b.jsonl"
    path.write_text("".join(json.dumps({**clean_loan(i), "payments": repr(clean_loan(i)["payments"])}) + "\n" for i in (700, 701)))
    second = audit_batch(reader.read_tape(spark, str(path)), folder, Policy(as_of=AS_OF))
    assert second and second != first and sorted(os.listdir(folder)) == names
    for n in names:
        table = spark.read.parquet(f"{folder}/{n}")
        assert {"tape_id", "run_id"} <= set(table.columns)
        assert {r.run_id for r in table.select("run_id").distinct().collect()} <= {first, second}
        for tape, rows in before[n].items():
            assert sorted(map(str, spark.read.parquet(f"{folder}/{n}/{tape}").collect())) == rows
    results = spark.read.parquet(f"{folder}/loan_results")
    assert not {"findings", "outcomes"} & set(results.columns) and results.filter("loan_id in (700, 701)").count() == 2
