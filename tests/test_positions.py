"""Source positions over several files, and the review order by ranges."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tape_audit.operators.sequences import global_rank
from tape_audit.plans.ledger import with_row_index


def files(tmp_path, sizes):
    want, at = {}, 0
    for name, size in sizes:
        lines = [f"{name}-{i}" for i in range(size)]
        (tmp_path / f"{name}.csv").write_text("v\n" + "\n".join(lines) + "\n")
        want |= {v: at + i for i, v in enumerate(lines)}
        at += size
    return want


def test_files_by_name_whatever_their_size(spark, tmp_path):
    want = files(tmp_path, [("a", 3), ("b", 2000), ("c", 50), ("d", 1)])
    for most in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            frame = with_row_index(spark.read.csv(str(tmp_path), header=True))
            assert {r.v: r.source_row_index for r in frame.collect()} == want
            few = frame.filter(F.col("source_row_index").between(2, 4)).orderBy("source_row_index")
            assert [r.v for r in few.collect()] == ["a-2", "b-0", "b-1"]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_that_come_from_no_file(spark):
    got = with_row_index(spark.range(100, numPartitions=7)).collect()
    assert sorted((r.id, r.source_row_index) for r in got) == [(i, i) for i in range(100)]
    assert with_row_index(spark.createDataFrame([], "v string")).collect() == []


def test_global_rank(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(3), rng.randrange(-(2**62), 2**62), i) for i in range(3000)] + [(1, 7, 3000 + i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "a int, b long, i long").repartition(5)
    ranked = global_rank(frame, [F.desc("a"), F.asc("b"), F.asc("i")], "rank")
    got = {r.i: r["rank"] for r in ranked.collect()}
    want = {r[2]: k for k, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1], r[2])), start=1)}
    assert got == want
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") <= 2 and "_n" in plan  # the only window runs over the sizes of the ranges
    assert global_rank(frame.limit(0), [F.asc("i")], "rank").collect() == []
