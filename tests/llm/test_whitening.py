"""Whitening against a dense eigenvalue decomposition of the exact covariance."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tape_audit.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label string, x int, component string"


def brute(rows: list[tuple[int | None, list | None]], most: int = 4):
    used = [(i, [math.floor(256 * float(np.float32(v))) for v in e]) for i, e in rows if e is not None and all(v is not None and math.isfinite(v) for v in e)]
    width = max((len(x) for _, x in used), default=0)
    used = [(i, tuple(x + [0] * (width - len(x)))) for i, x in used]
    fit = sorted({x for _, x in used})
    n = len(fit)
    sums = [sum(x[d] for x in fit) for d in range(width)]
    centred = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(width)] for x in fit]).reshape(n, width)
    values, vectors = np.linalg.eigh(centred.T @ centred / max(n, 1))
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [k for k in range(min(most, width)) if values[k] > 1e-12 * max(values[0], 1e-300)]
    out = {}
    for i, x in used:
        c = np.array([float(Fraction(n * x[d] - sums[d], n)) for d in range(width)])
        for k in keep:
            out.setdefault((i, k + 1), []).append((n, sum((n * x[d] - sums[d]) ** 2 for d in range(width)), c @ vectors[:, k] / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def check(spark, rows, most=4, near=1e-9):
    frame = spark.createDataFrame([(i, e, "l", 1, "c") for i, e in rows], SCHEMA).repartition(3)
    got, want = whitening.whiten(frame, most).collect(), brute(rows, most)
    assert len(got) == sum(map(len, want.values()))
    signs, seen = {}, {}
    for r in got:
        seen.setdefault((r.vec_id, r.component), []).append(r)
        assert r.identity_error < 1e-9
    for key, mine in seen.items():
        theirs = sorted(want[key], key=lambda w: (w[1], abs(w[2])))
        for r, (n, deviation, white, explained) in zip(sorted(mine, key=lambda r: (r.deviation, abs(r.whitened))), theirs, strict=True):
            assert (r.n, r.deviation) == (n, deviation) and abs(r.explained / explained - 1) < 1e-9
            if abs(white) > 1e-3:
                signs.setdefault(key[1], []).append(r.whitened * white > 0)
            assert abs(abs(r.whitened) - abs(white)) < near
    assert all(len(set(s)) == 1 for s in signs.values())
    return got


def test_random_vectors_with_copies_and_faults(spark):
    rng = np.random.default_rng(5)
    basis = rng.standard_normal((12, 12)) * np.linspace(2.0, 0.05, 12)[:, None]
    rows = [(i, (rng.standard_normal(12) @ basis).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(1000, 1300)]  # a hot vector counts once
    rows += [(5, rows[1][1]), (None, rows[2][1]), (6, None), (7, [1.0, None]), (8, [float("nan")]), (9, [float("inf")] * 12), (10, []), (11, [0.5, -0.25])]
    check(spark, rows)


def test_repeated_singular_values(spark):
    """A cross of equal arms: one eigenvalue for all four dimensions of the first group, which one start cannot separate."""
    rows = [(10 * d + k, [0.0] * d + [s * (4.0 if d < 3 else 1.0)] + [0.0] * (4 - d)) for d in range(5) for k, s in enumerate((1, -1))]
    frame = spark.createDataFrame([(i, e, "l", 1, "c") for i, e in rows], SCHEMA)
    got = whitening.whiten(frame).collect()
    shares = {r.component: r.explained for r in got}
    assert [round(shares[k] / shares[1], 9) for k in (1, 2, 3, 4)] == [1, 1, 1, round(1 / 16, 9)]
    assert max(r.identity_error for r in got) < 1e-9 and len(got) == 40


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [1.0, 2.0])] * 5])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame([(i, e, "l", 1, "c") for i, e in rows], SCHEMA)).collect() == []


def test_fewer_components_than_asked(spark):
    got = check(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])
    assert {r.component for r in got} == {1}
    check(spark, [(i, [float(i % 3), float(i // 3)]) for i in range(8)])


def test_deviation_beyond_a_long():
    rows = np.array([[10**9, 0], [3, -3]], np.int64)
    n, sums = 10**6, [5, 5]
    mean = np.array([s / n for s in sums])
    assert whitening._deviations(rows, n, sums, mean).tolist() == [None, (3 * n - 5) ** 2 + (3 * n + 5) ** 2]


def test_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    check(spark, rows, near=1e-8)
