"""Packing: the plan against document-by-document best fit, and the packed sequences against whole-text encoding."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tape_audit.llm import packing

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, length int, sequence_id string, block string"
TEXTS = ["Hello, World!", "", None, "word " * 700, "a b c " * 50, "Ünïcode ẞ İ", "x" * 3000, "same text", "same text", "tail\n\n"]


def one_by_one(lengths: list[int], capacity: int) -> list[int]:
    """Rooms left by best fit over single pieces, longest first."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        best = min((i for i, r in enumerate(rooms) if r >= n), key=rooms.__getitem__, default=None)
        if best is None:
            rooms.append(capacity - n)
        else:
            rooms[best] -= n
    return sorted(rooms)


def filled(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int]]]:
    """(offset, length) of all pieces by sequence; every rank of a length has one slot."""
    spans: dict[int, list[tuple[int, int]]] = {}
    ranks = {n: [] for n in counts}
    for length, first, bins, each, sequence, offset in packing.plan(counts, capacity):
        ranks[length] += range(first, first + bins * each)
        for i in range(bins * each):
            spans.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
    return spans


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit(lengths):
    spans = filled(Counter(lengths), 40)
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40
    assert sorted(40 - sum(n for _, n in parts) for parts in spans.values()) == one_by_one(lengths, 40)


def test_plan_does_not_grow_with_counts():
    counts = {n: 10**12 + n for n in range(1, 2049)}
    assert len(packing.plan(counts)) < 20_000


@pytest.mark.parametrize(("path", "by_word"), [(WORD, True), (WORD, False), (BYTE, False)])
def test_round_trip(spark, path, by_word):
    rows = [(i if i % 4 else None, t, 1, "x", "y") for i, t in enumerate(TEXTS * 3)] + [(7, "again", 0, None, None)] * 3
    packed = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), path, capacity=64, by_word=by_word)
    got, tokenizer = packed.collect(), Tokenizer.from_file(path)
    ids_of = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    want = Counter((r[0], k // 64, k, len(p := ids_of(r[1])[k : k + 64]), zlib.crc32(np.array(p, "<u4").tobytes())) for r in rows for k in range(0, len(ids_of(r[1])), 64))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, np.frombuffer(r.ids, "<u2").tolist()))
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for k, parts in by_sequence.items():
        joined = []
        for offset, ids in sorted(parts):
            assert offset == len(joined)
            joined += ids
        assert len(joined) == whole[k].length <= 64 and np.frombuffer(whole[k].ids, "<u2").tolist() == joined
        assert [m.offset for m in whole[k].members] == sorted(o for o, _ in parts)
    assert len(by_sequence) == len(one_by_one([r.length for r in got], 64))


def test_no_documents(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), WORD, by_word=True).collect() == []


def test_hot_length_is_ranked_in_blocks(spark):
    rows = [(i, "one", 1, "x", "y") for i in range(2000)] + [(i, "one two three " * (i % 9), 1, "x", "y") for i in range(1000)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), WORD, capacity=32, by_word=True, block=64).select("sequence_id", "offset", "length").collect()
    assert len(got) == 3000 and len({(r.sequence_id, r.offset) for r in got}) == 3000
    assert len({r.sequence_id for r in got}) == len(one_by_one([r.length for r in got], 32))
