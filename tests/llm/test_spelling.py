"""Spelling variants against all pairs of words, and the affected-gram bound by trial."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tape_audit.llm import spelling, token_files

SCHEMA = "doc_id long, text string, word string, n int, key string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows: list[tuple]) -> list[tuple]:
    counts: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            p = h % len(run)
            counts[run[:p] + run[p + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    neighbours = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(neighbours[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(neighbours[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def compared(spark, rows, **kw):
    frame = spark.createDataFrame([(i, t, "w", 1, "k") for i, t in rows], SCHEMA).repartition(3)
    got = spelling.variants(frame, **kw)
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == brute(rows)


def corpus(seed: int, letters: str, size: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([4, 5, 6, 7, 9, 12]))) for _ in range(size)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randrange(60)):
            w = base[min(int(rng.expovariate(0.05)), size - 1)]
            p = rng.randrange(len(w))
            words.append(rng.choice([w, w, w.title(), w[:p] + w[p + 1 :], w[:p] + rng.choice(letters) + w[p:], w[:p] + rng.choice(letters) + w[p + 1 :]]))
        rows.append((rng.choice([i, i, None, 7]), " ".join(words) + rng.choice(["", ".", "\n", "’"])))
    return rows


@pytest.mark.parametrize(("letters", "kw"), [("ab", {}), ("abcdeé", {}), ("abcdeé", {"frequent": 2, "most": 40}), ("abcdefghijklmnopqrsß×÷ÿ", {"frequent": 1})])
def test_all_pairs(spark, letters, kw):
    compared(spark, corpus(len(letters), letters, 80), **kw)


def test_odd_rows(spark):
    long = "y" * 5000
    rows = [(1, None), (2, ""), (3, "... 123 ½ ĀĒĪ"), (None, "alpha ALPHA Alpha alphas alphas alphas"), (None, "alpha"), (1, f"{long} {long}"), (1, f"{long} {long}z {long}z {long}z"), (4, "ÀÉÎ àéîõü ÀÉÎÕÜ ÀÉÎÕÜ àéîõü àéîõü ÀÉÎÕÜ")]
    compared(spark, rows * 2)


def test_no_words(spark):
    compared(spark, [])
    compared(spark, [(1, None), (2, "a bc def")])


def test_long_chain(spark):
    steps = ["aaaaaaaa"[: 8 - k] + "b" * k for k in range(8)]
    compared(spark, [(k, f"{w} " * (3 << k)) for k, w in enumerate(steps)])


WORD = st.text("abé", min_size=5, max_size=9)


@settings(max_examples=500, deadline=None)
@given(WORD, st.integers(0, 9), st.sampled_from("abé"), st.sampled_from(["insert", "delete", "replace"]), st.sets(st.text("^abé$", min_size=2, max_size=4), max_size=40))
def test_bound_on_affected_grams(word, at, letter, kind, frequent):
    """A shared gram stands in the first lists of both words, at the place that the join asks for."""
    at %= len(word)
    other = {"insert": word[:at] + letter + word[at:], "delete": word[:at] + word[at + 1 :], "replace": word[:at] + letter + word[at + 1 :]}[kind]
    if other == word or min(len(word), len(other)) < 5:
        return
    a, b = sorted([word, other], key=len)
    firsts = []
    for w in (a, b):
        grams = spelling.grams_of(w, dict.fromkeys(frequent, 1))
        bound = spelling.affected(grams)
        assert bound < len(grams)
        firsts.append({(g, i) for _, g, i in sorted((int(g in frequent), g, i) for i, g in enumerate(grams))[: bound + 1]})
    grown = len(b) - len(a)
    assert any((g, i) in firsts[1] or (grown and (g, i + 1) in firsts[1]) for g, i in firsts[0])


def test_slices_of_a_batch(monkeypatch):
    """Texts are worked on in slices of a batch; the slices give what the whole gives."""
    rows = corpus(3, "abcé", 30)
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    totals = []
    for size in (10**9, 150):
        monkeypatch.setattr(token_files, "ENCODE_BYTES", size)
        total: Counter[str] = Counter()
        for part in spelling._counted(iter([batch]), 5, 97):
            total.update(dict(zip(part.column("word").to_pylist(), part.column("n").to_pylist(), strict=True)))
        totals.append(total)
    assert totals[0] == totals[1] and len(totals[0]) > 20
