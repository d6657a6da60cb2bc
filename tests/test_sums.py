"""Sums beyond a long are NULL for the whole loan, never the rest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tape_audit.plans import features as X
from tape_audit.plans.ledger import KEY


def test_folded_sum(spark):
    rows = [("fits", 5, 3), ("fits", None, 2), ("product", 5_000_000_000, 4_000_000_000), ("product", 7, 1),
            ("sum", 1 << 62, 1), ("sum", 1 << 62, 1), ("none", None, 9)]
    df = spark.createDataFrame(rows, "k string, v long, copies long")
    got = {r.k: r.s for r in df.groupBy("k").agg(X.folded_sum(F.col("v")).alias("s")).collect()}
    assert got == {"fits": 15, "product": None, "sum": None, "none": 0}


def test_reductions_after_a_lost_one_are_unknown(spark):
    day = lambda n: dt.date(2024, 1, n)
    keys = ", ".join(f"{k} string" for k in KEY)
    key = lambda k: (k,) * len(KEY)
    reductions = spark.createDataFrame([(*key("a"), day(2), 10), (*key("a"), day(4), None), (*key("b"), day(2), 1)], f"{keys}, day date, reduction long")
    probes = spark.createDataFrame([(*key(k), day(n)) for k in "ab" for n in (1, 3, 4, 5)], f"{keys}, day date")
    got = {(r[0], r["day"].day): r["reduced"] for r in X.reduced_before(reductions, probes).collect()}
    assert got == {("a", 1): 0, ("a", 3): 10, ("a", 4): 10, ("a", 5): None, ("b", 1): 0, ("b", 3): 1, ("b", 4): 1, ("b", 5): 1}
