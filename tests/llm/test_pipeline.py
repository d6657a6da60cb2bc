"""The pipeline on a small corpus against its stages done by hand, and the registered queries against their SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tape_audit.llm.queries import ORACLES, QUERIES
from tests.llm.test_decontamination import prose
from tests.llm.test_simhash import slow_components
from tests.llm.test_spread import slow_mix
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and "pipeline" in queries()


def test_stages(spark, tmp_path):
    import random

    rng = random.Random(21)
    items = [(i, " ".join(prose(rng, 30))) for i in range(5)]
    texts = [" ".join(prose(rng, 120)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "en", "s1", 1) for i in range(10)]  # copies
    rows += [(200 + i, texts[20 + i] + " " + items[i][1], "en", "s2", 1) for i in range(5)]  # leaks
    rows += [(300, None, "en", "s0", 0), (301, "12 34", "en", "s0", 5), (302, "", None, None, 0), (5, texts[5], "en", "s2", 1)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = sorted(tuple(r) for r in docs.collect())
        docs = spark.createDataFrame(kept[name], SCHEMA)
    good = [r for r in rows if r[0] not in (300, 301, 302)]
    assert kept["language_id"] == sorted(good)
    least = {c for _, _, c in slow_components([r[:2] for r in good])}
    assert {r[0] for r in kept["near_dedup"]} == least and len(kept["near_dedup"]) == len(least)
    assert kept["decontaminate"] == [r for r in kept["near_dedup"] if not 200 <= r[0] < 205]
    copies = {d: int(t / n + 0.5) for d, n, _, _, t in slow_mix([(r[0], r[1], r[3]) for r in kept["decontaminate"]])[0]}
    assert kept["mix_sources"] == sorted(r for r in kept["decontaminate"] for _ in range(copies[r[0]]))

    out = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [r[0] for r in kept["mix_sources"]]
    assert [r["start"] for r in out] == [sum(r["n_tokens"] for r in out[:i]) for i in range(len(out))]


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_with_clashing_names_and_tidying(spark, tmp_path):
    """Columns of the user's own, under names that stages might use, come through; earlier tables go, those read stay."""
    from tape_audit.operators.staging import staged_tables

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80).selectExpr("*", "1 as found", "2 as row", "3 as row_at", "4 as id", "5 as copies", "6 as copy", "'x' as _row")
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    stages, seen = dict(corpus_pipeline.STAGES), set()
    for name in ("language_id", "near_dedup", "mix_sources"):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        now = set(staged_tables(spark))
        assert not seen & now
        seen, docs = set(corpus_pipeline._DONE), spark.read.parquet(str(tmp_path / name))
    assert docs.where("found = 1 and row = 2 and row_at = 3 and id = 4 and copies = 5 and copy = 6 and _row = 'x'").count() == docs.count() > 0
