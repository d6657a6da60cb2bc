"""Elias-Fano codes, token files and token attribution: exact round trips against the tokenizers library."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tape_audit.llm import attribution, token_files
from tape_audit.llm.elias_fano import EliasFano
from tape_audit.operators.staging import staged_root

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, start int, n_tokens string"
TEXTS = ["Hello, World! It's 12 o'clock.", "", None, "É́tude ẞ İstanbul ΣΑΣ", "a\n\nb\t c \r\n", "x" * 5000, "word " * 40_000, "<|endoftext|> and <|startoftext|>word",
         "tail.\x1c\x85 odd\xa0space line", " 　wide", "don't we'll I'VE", "😀👍🏽!", "...", "\n", "same", "same"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano(values):
    values = np.sort(np.array(values, np.int64))
    code = EliasFano.encode(values)
    assert code.all().tolist() == values.tolist()
    assert [code.get(i) for i in range(0, len(values), 7)] == values[::7].tolist()
    bits = 8 * (len(code.high) + len(code.low))
    assert bits <= len(values) * (3 + code.width) + 64


def rows() -> list[tuple]:
    texts = [(i * 3 - 9, t, 1, "x") for i, t in enumerate(TEXTS)]
    return [*texts, (None, "no id", 1, "x"), (None, "no id", 1, "x"), (0, "tied", 1, "x"), (2**62, "far", 1, "x"), (-(2**62), "low", 1, "x")]


def expected() -> list[tuple]:
    tokenizer, at, out = Tokenizer.from_file(WORD), 0, []
    for doc_id, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("by_word", [True, False])
def test_files_round_trip(spark, by_word):
    got = token_files.token_digests(spark.createDataFrame(rows(), SCHEMA).repartition(3), WORD, by_word)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == expected()


def test_random_access(spark):
    manifest = token_files.write_token_files(spark.createDataFrame(rows(), SCHEMA), f"{staged_root(spark)}/random-access", WORD, True)
    for r in manifest.collect():
        file = token_files.TokenFile(r["path"])
        for i, (_, _, ids) in enumerate(file.documents()):
            assert file.tokens(i).tolist() == ids.tolist()


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_files.token_digests(empty, WORD, True).collect() == []
    assert attribution.section_tokens(empty, BYTE).collect() == []


TOKENIZER, ENCODER, SPANS = Tokenizer.from_file(WORD), token_files.WordEncoder(WORD, known=9), attribution.SpanEncoder(BYTE, known=9)
PLAIN = Tokenizer.from_file(BYTE)
PLAIN.encode_special_tokens = True


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["Ab", "é", "É", ".", ",", " ", "  ", "\n", "\t", "'s", "12", "́", "İ", "Σ", "<|endoftext|>", "\x1c", "\xa0", "-"]), max_size=20).map("".join)))
def test_words_encode_like_whole_texts(text):
    ids, counts = ENCODER.batch(pa.array(["", text, None, text], pa.string()).slice(1))
    assert counts.tolist() == [len(ids) // 2, 0, len(ids) // 2] and ids[: counts[0]].tolist() == ids[counts[0] :].tolist()
    assert ids[: counts[0]].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert SPANS.spans(text).tolist() == [list(o) for o in PLAIN.encode(text, add_special_tokens=False).offsets]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_equals_brute_force(spark, rule):
    cuts = lambda text: np.array([i for i in range(1, len(text)) if i % 7 == 0 and i < 5000], np.int64)
    got = attribution.section_tokens(spark.createDataFrame(rows(), SCHEMA), BYTE, rule, cuts).collect()
    want = []
    for doc_id, text, *_ in rows():
        if not text:
            want.append((doc_id, 0, 0, 0, [], []))
            continue
        edges = [0, *cuts(text).tolist(), len(text)]
        counts, crossing = [0] * (len(edges) - 1), 0
        offsets = PLAIN.encode(text, add_special_tokens=False).offsets
        for a, b in offsets:
            base = max(0, min(a // 7, len(counts)) - 2)
            held = [max(0, min(b, edges[i + 1]) - max(a, edges[i])) for i in range(base, min(len(counts), b // 7 + 2))]
            parts = [base + i for i, h in enumerate(held) if h] or [len(counts) - 1]
            crossing += len(parts) > 1
            counts[{"first": parts[0], "last": parts[-1], "most": base + held.index(max(held))}[rule]] += 1
        want.append((doc_id, len(offsets), len(counts), crossing, [b - a for a, b in zip(edges, edges[1:])], counts))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r["crossing"] for r in got) > 100


def test_every_latin_letter_encodes_like_whole_texts():
    """Of a few letters the small form lies beyond the Latin blocks, or in another one."""
    letters = [chr(c) for c in range(0xC0, 0x250)]
    ids, counts = ENCODER.batch(pa.array(letters))
    whole = [TOKENIZER.encode(x, add_special_tokens=False).ids for x in letters]
    assert counts.tolist() == [len(w) for w in whole] and ids.tolist() == sum(whole, [])


def _own_mb() -> float:
    return sum(int(line.split()[1]) for line in Path("/proc/self/smaps_rollup").read_text().splitlines() if line.startswith("Pss_Anon")) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="needs Linux")
def test_a_finished_task_holds_no_freed_memory(tmp_path):
    """What stays in an idle worker adds to the memory of the next stage's executor."""
    texts = [" ".join(f"w{i * k % 997}" for k in range(300)) for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    files = list(token_files._write(iter([batch]), tmp_path.as_uri(), WORD, True, 1))
    assert files[0].column("n_docs").to_pylist() == [len(texts)]
    held = _own_mb()
    pa.default_memory_pool().release_unused()
    assert held - _own_mb() < 10
