"""Cleaning and typing: one row per case, one job per table of cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tape_audit.config import Policy, PolicyError
from tape_audit.functions import irr
from tape_audit.functions import normalize as N
from tape_audit.operators import diary
from tape_audit.plans import tape_checks as TC
from tape_audit.plans.ledger import with_row_index

NUMBERS = [
    ("1.5", 1.5, None), ("1.234,56", 1234.56, None), ("1,234.56", 1234.56, None), ("1 234,5", 1234.5, None),
    ("EUR 5", 5.0, None), ("5 €", 5.0, None), ("1.234.567", 1234567.0, None), ("1,23", 1.23, None), (".5", 0.5, None),
    ("1,234", None, "separator may be decimal or grouping"), ("1 23", None, "digits are not grouped by thousands"),
    ("1,2,3", None, "digits are not grouped by thousands"), ("1e400", None, "number too large"),
    ("abc", None, "no number of finite size"), ("nan", None, None), ("", None, None), (None, None, None),
]
INTEGERS = [
    ("12", 12, None), ("12.0", 12, None), ("1e2", 100, None), ("9007199254740993", 9007199254740993, None),
    ("1.5", None, "no whole number"), ("1.0000001", None, "no whole number"),
    ("99999999999999999999", None, "whole number beyond 64 bits"),
]
D = dt.date
DATES = [
    ("2024-01-15T00:00:00.000", D(2024, 1, 15), "iso", 1), ("2024-1-5", D(2024, 1, 5), "iso", 1),
    ("15/02/2024", D(2024, 2, 15), "%d/%m/%Y", 1), ("02/15/2024", D(2024, 2, 15), "%m/%d/%Y", 1),
    ("02/03/2024", D(2024, 3, 2), "%d/%m/%Y", 2), ("02/02/2024", D(2024, 2, 2), "%d/%m/%Y", 1),
    ("2024-02-30", None, None, None), ("13/13/2024", None, None, None), (" NaT ", None, None, None),
]


def _typed(spark, kind, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    return [r.v for r in N.type_columns(df, {"v": (kind, F.col("t"))}, ["i"]).orderBy("i").collect()]


def test_numbers(spark):
    got = [(v.value, v.error) for v in _typed(spark, "float", [n[0] for n in NUMBERS])]
    assert got == [(n[1], n[2]) for n in NUMBERS]


def test_integers(spark):
    got = [(v.value, v.error) for v in _typed(spark, "int", [n[0] for n in INTEGERS])]
    assert got == [(n[1], n[2]) for n in INTEGERS]


def test_dates_keep_both_readings(spark):
    got = [(v.value, v.fmt, None if v.readings is None else len(v.readings))
           for v in _typed(spark, "date", [d[0] for d in DATES])]
    assert got == [d[1:] for d in DATES]


REC = ("{'Loan ID': '1', 'Payment date': '15/02/2024', 'Repayment date': None, 'Type': 'principal', "
       "'State': 'pending', 'Amount': 94.62, 'Pending amount': 94.62}")


def test_nested_cells_survive(spark):
    cells = [f"[{REC}, {REC}]", f"[{REC}, {REC[:40]}", "garbage", None, "[]", f"[{REC}] junk", f"[{REC}, 5, None]", REC]
    df = spark.createDataFrame(list(enumerate(cells)), "k int, payments string")
    out = {r.k: r for r in diary.parse_nested(df, "payments", 10_000).collect()}
    n = lambda k: None if out[k].records is None else len(out[k].records)
    assert [n(k) for k in range(8)] == [2, 1, None, None, 0, 1, 3, None]
    assert [out[k].diary_truncated for k in range(8)] == [False, True, False, False, False, True, False, False]
    assert [out[k].diary_error is not None for k in range(8)] == [False, False, True, True, False, False, False, True]
    assert out[1].dropped_tail_chars == 42 and out[5].dropped_tail_chars == 6


def test_malformed_records_become_issues(spark):
    cells = ["[{'Loan ID': '1', 'Amount': True, 'Extra': 1}]", "[5]", f"[{REC.replace('principal', 'gift')}]"]
    df = diary.parse_nested(spark.createDataFrame(list(enumerate(cells)), "k int, payments string"), "payments")
    rows = {r.k: r for r in diary.type_records(diary.explode_nested(df, ["k"]), ["k"]).collect()}
    fields = lambda k: [i.field for i in rows[k].issues]
    assert fields(0)[:2] == ["keys", "keys"] and "Amount" in fields(0)
    assert fields(1) == ["record"] and fields(2) == ["Type"] and rows[2].type == "unknown"


def test_irr_known_answers(spark):
    flows = [(1, D(2020, 1, 1), -100.0), (1, D(2021, 1, 1), 200.0), (2, D(2020, 1, 1), 5.0),
             (3, D(2020, 1, 1), -100.0), (3, D(2021, 12, 31), -1.0)]
    df = spark.createDataFrame(flows, "g int, d date, a double")
    got = {r.g: r.r for r in irr.xirr(df, ["g"], "d", {"r": "a"}).collect()}
    assert got[1] == pytest.approx(2 ** (365 / 366) - 1, abs=1e-6) and got[2] is None and got[3] is None
    npv = {r.g: r.npv for r in irr.xnpv(df, ["g"], "d", "a", 0.1).collect()}
    assert npv[1] == pytest.approx(-100 + 200 / 1.1 ** (366 / 365))


def test_policy_is_strict():
    with pytest.raises(PolicyError):
        Policy.from_dict({"lateness": {"grace_days": 40}})
    with pytest.raises(PolicyError):
        Policy.from_dict({"latency": {}})
    with pytest.raises(PolicyError):
        Policy.from_dict({"tape": {"cell_limit": True}})
    with pytest.raises(PolicyError):
        Policy(disabled_rules=("Z9",))
    assert Policy.from_dict({"as_of": "2024-01-31"}).digest() != Policy().digest()


def test_exact_integers_and_identifiers(spark):
    cells = ["1e-7", "1.0000001e0", "1.5e1", "12e2", "0e-9", "1e30", "120e-1", "121e-1", "1.0000001E7", "7.0"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    ints = N.type_columns(rows, {"v": ("int", F.col("c"))}, ["i"]).orderBy("i").select("v.*").collect()
    assert [r.value for r in ints] == [None, None, 15, 1200, 0, None, 12, None, 10000001, 7]
    assert [r.error for r in ints] == ["no whole number", "no whole number", None, None, None, "whole number beyond 64 bits",
                                       None, "no whole number", None, None]
    doubles = spark.createDataFrame([(1, 10000001.0), (2, 12.0), (3, 1.5)], "i int, c double")
    ids = N.type_columns(doubles, {"v": ("id", F.col("c"))}, ["i"]).orderBy("i").select("v.*").collect()
    assert [(r.value, r.text) for r in ids] == [(10000001, "10000001"), (12, "12"), (None, "1.5")]


def test_literal_dialect(spark):
    cells = ["[{'a': 1}]\n", "\t[{'a': 1}]\t", "\n[{'a': 1},]", "[{'a': 1., 'b': +1}]", "[{'a':   None , 'b': .5,}]", "[{'a': 'x, y'}]"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, payments string")
    rows = diary.parse_nested(df, "payments").orderBy("i").collect()
    assert all(r.diary_error is None and not r.diary_truncated and r.dropped_tail_chars == 0 and len(r.records) == 1 for r in rows)
    assert "null" in rows[4].records[0] and "0.5" in rows[4].records[0] and "1.0" in rows[3].records[0]


def test_shared_rows_with_nulls_name_their_members(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, None, 5), (3, "d", 5), (3, "d", 5)], "loan int, due string, cents int")
    assert TC.shared_rows(rows, ["due", "cents"], "loan").count() == 1
    assert sorted(r.loan for r in TC.shared_row_members(rows, ["due", "cents"], "loan").collect()) == [1, 2]


def test_row_index_stays_in_the_jvm(spark, tmp_path):
    spark.range(0, 1000, 1, 1).write.csv(f"{tmp_path}/t")
    df = with_row_index(spark.read.option("maxPartitionBytes", 500).csv(f"{tmp_path}/t"))
    assert sorted(r.source_row_index for r in df.collect()) == list(range(1000))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan
