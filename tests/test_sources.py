"""CSV whose lines are rows is read in splits; any other CSV is read whole. Both give the same rows."""

from __future__ import annotations

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tape_audit.sources.reader import count_rows, lines_are_rows, read_tape


@pytest.mark.parametrize(("text", "by_line"), [
    ('a,b\n1,2\n3,4\n', True), ('a,b\n"1","x, ""y"" z"\n"""q""",""\n', True), ('a,b\n1,"x\ny"\n', False), ('a,b\n1,x"y\n', False),
    ('a,b\nx"y,"z\nw",v"u\n', False), ('a,b\n1,"x""\ny"\n', False), ('a,b\r\n"1",2\r\n', True), ('a,b\n"1" ,2\n', False),
])
def test_proof(spark, tmp_path, text, by_line):
    path = tmp_path / "t.csv"
    path.write_text(text, newline="")
    assert lines_are_rows(spark, str(path)) is by_line


cell = st.text(st.sampled_from('ab," \n'), min_size=1, max_size=6)


@settings(max_examples=12, deadline=None)
@given(rows=st.lists(st.tuples(cell, cell), min_size=1, max_size=8), quoting=st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
def test_rows_come_back(spark, tmp_path_factory, rows, quoting):
    out = io.StringIO()
    writer = csv.writer(out, quoting=quoting, lineterminator="\n")
    writer.writerow(("a", "b"))
    writer.writerows(rows)
    path = tmp_path_factory.mktemp("csv") / "t.csv"
    path.write_text(out.getvalue(), newline="")
    assert lines_are_rows(spark, str(path)) == (not any("\n" in c for r in rows for c in r))
    assert [tuple(r) for r in read_tape(spark, str(path)).collect()] == rows
    assert count_rows(spark, str(path)) == len(rows)


def test_one_large_file_is_several_tasks(spark, tmp_path):
    path, before = tmp_path / "t.csv", spark.conf.get("spark.sql.files.maxPartitionBytes")
    path.write_text("id,note\n" + "".join(f'{i},"said ""x"", {i}"\n' for i in range(20_000)))
    broken = tmp_path / "u.csv"
    broken.write_text(path.read_text() + '20000,"a\nb"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split, whole = read_tape(spark, str(path)), read_tape(spark, str(broken))
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert split.exceptAll(whole).isEmpty() and (split.count(), whole.count()) == (20_000, 20_001)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
