"""Arriving files: several to a run, delivered twice, and a run that dies between its tables."""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tape_audit.config import Policy
from tape_audit.streaming.onboard import deliveries, onboard, onboard_files, published
from tests.test_audit import clean_loan

SCHEMA = "kind string, value long"


def write(path, rows: list[tuple]) -> None:
    path.write_text("".join(json.dumps({"kind": k, "value": v}) + "\n" for k, v in rows))


def tables(rows):
    return {"totals": rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "rows": rows}


def dying(rows):
    broken = rows.withColumn("value", F.raise_error(F.lit("lost")).cast("long"))
    return {"totals": tables(rows)["totals"], "rows": broken}


def arrive(spark, base, make, files: int = 2) -> None:
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).json(str(base / "in"))
    onboard_files(source, str(base / "out"), str(base / "checkpoint"), make).awaitTermination()


def totals(spark, base) -> dict:
    rows = published(spark, str(base / "out"), "totals").groupBy("kind").agg(F.sum("n"), F.sum("total")).collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def expected(*files: list[tuple]) -> dict:
    n, total = Counter(), Counter()
    for k, v in (row for f in files for row in f):
        n[k] += 1
        total[k] += v or 0
    return {k: (n[k], total[k]) for k in n}


def test_files_count_once_through_repeats_and_a_death(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = [[("a", i), ("b", 2 * i), ("a", i)] for i in range(1, 5)]
    for i, rows in enumerate(files):
        write(tmp_path / "in" / f"{i}.json", rows)
    write(tmp_path / "in" / "4.json", list(reversed(files[0])))  # the first again: same rows, other order and name
    arrive(spark, tmp_path, tables)
    assert totals(spark, tmp_path) == expected(*files)
    assert deliveries(spark, str(tmp_path / "out")).count() == 4

    late = [[("a", 100), (None, 7)], [("c", 5)]]
    for i, rows in enumerate(late):
        write(tmp_path / "in" / f"late{i}.json", rows)
    with pytest.raises(Exception, match="lost"):
        arrive(spark, tmp_path, dying)
    assert totals(spark, tmp_path) == expected(*files), "a run without its marker must not be seen"
    arrive(spark, tmp_path, tables)  # from the checkpoint
    assert totals(spark, tmp_path) == expected(*files, *late)
    assert published(spark, str(tmp_path / "out"), "rows").count() == sum(map(len, files + late))

    write(tmp_path / "in" / "again.json", late[1])
    arrive(spark, tmp_path, dying)  # nothing new, so nothing is made
    assert totals(spark, tmp_path) == expected(*files, *late)


def test_a_new_checkpoint_repeats_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("a", 1), ("b", 2)]
    write(tmp_path / "in" / "0.json", rows)
    arrive(spark, tmp_path, tables)
    source = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    onboard_files(source, str(tmp_path / "out"), str(tmp_path / "other"), tables).awaitTermination()
    assert totals(spark, tmp_path) == expected(rows)


def test_tapes_arrive_one_by_one(spark, tmp_path):
    (tmp_path / "in").mkdir()
    loans = [{**clean_loan(i), "payments": json.dumps(clean_loan(i)["payments"])} for i in (31, 32)]
    for name, loan in (("a", loans[0]), ("b", loans[1]), ("again", loans[0])):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(loan) + "\n")
    onboard(spark, str(tmp_path / "in"), list(loans[0]), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
            Policy(as_of=dt.date(2024, 12, 31))).awaitTermination()
    results = spark.read.parquet(f"{tmp_path}/out/loan_results").select("loan_id", "verdict").collect()
    assert sorted((r[0], r[1]) for r in results) == [(31, "normal"), (32, "normal")]
    assert spark.read.parquet(f"{tmp_path}/out/run").count() == 2
