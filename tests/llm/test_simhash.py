"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash

from tape_audit.llm import simhash

SCHEMA = "doc_id long, text string, fingerprint int, component_id string"


def slow_fingerprint(text: str | None) -> int:
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows: list[tuple]) -> list[tuple]:
    fps = [slow_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    ids = {g: min((r[0] for r, x in zip(rows, group) if x == g and r[0] is not None), default=None) for g in group}
    return sorted(((r[0], f"{f:016x}", ids[g]) for r, f, g in zip(rows, fps, group)), key=str)


def texts() -> list[tuple]:
    rng, rows = random.Random(3), []
    for _ in range(12):
        base = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(90)) for _ in range(400)]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = "Changed" + str(rng.randrange(9))
            rows.append(" ".join(words))
    rows += ["", None, " \t\n", "one", "one two", "ONE Two", "one two three", "a b c d", "É É É É", "x " * 50_000, "x y " * 300]
    return [(i, t) for i, t in enumerate(rows)] + [(3, rows[3]), (3, "tied id"), (None, rows[0]), (None, "no id at all")]


@pytest.mark.parametrize("block", [2, 1024])
def test_components_equal_brute_force(spark, block):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = [tuple(r) for r in simhash.near_duplicates(docs, block).collect()]
    assert sorted(got, key=str) == slow_components(rows)


def test_dense_ball_needs_chains(spark):
    """Fingerprints along a path of single-bit steps, around a hub: one component, whatever the blocks."""
    rng = random.Random(5)
    fps, now = {0}, 0
    for _ in range(300):
        now ^= 1 << rng.randrange(64)
        fps.add(now)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 16)
    assert {r["root"] for r in simhash.components(links).collect()} == {min(s[0] for s in signed)}
    assert simhash.components(links).count() == len(fps)


def test_distance_is_exactly_three(spark):
    def together(a: int, b: int) -> bool:
        pair = [(x - (1 << 64) if x >> 63 else x,) for x in (a, b)]
        return simhash.near_links(spark.createDataFrame(pair, "fp long")).count() > 0

    base = 0x0123456789ABCDEF
    assert together(base, base ^ (1 << 0 | 1 << 31 | 1 << 63))
    assert together(base, base ^ (1 << 1 | 1 << 40 | 1 << 63))
    assert not together(base, base ^ (1 << 0 | 1 << 31 | 1 << 32 | 1 << 63))


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
