"""Hot-key paths give the same rows as the plain ones, and brute force agrees."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tape_audit.functions import digits
from tape_audit.operators import conventions as C
from tape_audit.operators.sequences import global_rank, ordered_prefix
from tape_audit.plans import driver_tables as DT
from tape_audit.plans import rollups
from tape_audit.plans.health import combine, top_values
from tape_audit.plans.tape_checks import shared_rows

SF = "/root/testdata/sf0.001"


def test_running_sums_agree_on_a_hot_key(spark):
    rnd = random.Random(7)
    data = [(0 if rnd.random() < 0.4 else i % 17, rnd.randrange(9), i, rnd.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, day int, seq long, v long")
    pick = lambda giant: {
        (r.k, r.seq): (r.s, r.s_total)
        for r in ordered_prefix(df, ["k"], "day", "seq", {"s": F.col("v")}, giant=giant).collect()}
    got, total, want = pick(True), {}, {}
    assert got == pick(False)
    for k, day, seq, v in sorted(data):
        total[k] = total.get(k, 0) + v
        want[(k, seq)] = total[k]
    assert {key: s for key, (s, _) in got.items()} == want


def test_rank_by_ranges_is_the_global_rank(spark):
    rnd = random.Random(3)
    data = [(rnd.randrange(4), rnd.randrange(5), i) for i in range(2000)]
    df = spark.createDataFrame(data, "a int, b int, i long")
    ranked = global_rank(df, [F.col("a").desc(), F.col("b").asc(), F.col("i").asc()], "r").collect()
    want = {t: n for n, t in enumerate(sorted(data, key=lambda t: (-t[0], t[1], t[2])), start=1)}
    assert {(r.a, r.b, r.i): r.r for r in ranked} == want


def test_tags_do_not_depend_on_the_giant_path(spark):
    p = DT.order_payments(DT.table(spark, SF, "lineitem"))
    cols = [*C.KEY, "payment_seq", *C.TAGS]
    a = C.tag_conventions(p, giant_loans=True).select(cols)
    b = C.tag_conventions(p, giant_loans=False).select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.filter("is_closure_row").isEmpty()


def test_same_result_for_other_partitionings(spark):
    p = DT.order_payments(DT.table(spark, SF, "lineitem"))
    base = None
    for n in (1, 4, 7):
        row = C.add_subsets(C.tag_conventions(p.repartition(n), giant_loans=True), DT.AS_OF).agg(
            F.sum("paid_micros"), F.sum("exposure_micros"), F.count_if("is_closure_row"),
            F.count_if("is_duplicate")).first()
        base = base or row
        assert row == base


def test_shared_rows_with_a_dominant_value(spark):
    data = [(1, i) for i in range(500)] + [(1, 7)] * 300 + [(2, 5), (2, 5), (3, 1), (3, 2)]
    got = {r.v: (r.owners, r.first_owner, r.last_owner) for r in
           shared_rows(spark.createDataFrame(data, "v int, o int"), ["v"], "o").collect()}
    assert got == {1: (500, 0, 499), 3: (2, 1, 2)}


def test_top_values_are_whole(spark):
    counts = spark.createDataFrame([("c", f"v{i:04d}", i % 50) for i in range(3000)], "column string, value string, n long")
    got = top_values(counts).orderBy("rank").collect()
    want = sorted(((-(i % 50), f"v{i:04d}") for i in range(3000)))[:50]
    assert [(-r.n, r.value) for r in got] == want and got[0].distinct_values == 3000


def test_digit_deviation_of_a_constant_population(spark):
    df = spark.createDataFrame([(10_000 + i,) for i in range(50)], "cents long")
    r = digits.digit_profile(df, "cents", []).first()
    import math
    p = [math.log10(1 + 1 / d) for d in range(1, 10)]
    assert r.first_digit_mad == round((1 - p[0] + sum(p[1:])) / 9, 4) and r.first_digit_band == "nonconformity"


def test_profile_merge(spark):
    rows = [("rows", "", "", "sum", 3), ("rows", "", "", "sum", 4), ("m", "c", "", "max", 9), ("m", "c", "", "max", 2),
            ("w", "c", "", "min", 1), ("w", "c", "", "min", 0)]
    got = {r.metric: r.value for r in combine(spark.createDataFrame(
        rows, "metric string, column string, key string, how string, value long")).collect()}
    assert got == {"rows": 7, "m": 9, "w": 0}


def test_batches_must_tile(spark):
    meta = "batch_index int, batch_count int, row_start long, row_stop long, rows_read long, policy_digest string"
    rows = spark.range(10).select(F.when(F.col("id") < 4, 0).otherwise(1).alias("batch_index"),
                                  F.col("id").alias("source_row_index"))
    good = spark.createDataFrame([(0, 2, 0, 4, 4, "a"), (1, 2, 4, 10, 6, "a")], meta)
    bad = spark.createDataFrame([(0, 2, 0, 4, 4, "a"), (1, 2, 5, 10, 5, "b")], meta)
    assert rollups.batch_merge_check(good, rows).filter("n > 0").isEmpty()
    problems = {r.problem for r in rollups.batch_merge_check(bad, rows).filter("n > 0").collect()}
    assert problems == {"policy_digest_differs", "cuts_do_not_tile", "rows_outside_bounds"}
