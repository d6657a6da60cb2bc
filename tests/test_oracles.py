"""Registered queries against their SQL twins on the smallest tables; tools/check_oracles.py runs all of them."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tape_audit.plans.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = ("payment_tags", "rules_lateness", "rules_temporal", "instalment_interest", "realised_rate", "delay_sequences",
          "nested_roundtrip", "parse_dates", "parse_numbers", "shared_rows", "benford_profile", "value_counts_top",
          "batch_merge_check", "stream_onboarding")


@pytest.mark.parametrize("name", SAMPLE)
def test_twin(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 1500
