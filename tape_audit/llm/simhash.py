"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. When two fingerprints differ in at most three bits, one segment
differs in at most one. Every segment is therefore indexed as it is and with each single bit wildcarded; equal
variants are candidates, and the whole fingerprints are compared. For a wildcarded bit only a pair with different
values there is new, so a pair meets at most once per segment.

Equal fingerprints are folded before anything is indexed, so exact copies cost nothing. Members of a crowded
variant are dealt into blocks and every pair of blocks is one task's work: no group is gathered whole and no list
of all its pairs is made, since a task returns only a spanning forest of the links it has verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.llm.buffers import raw_texts
from tape_audit.llm.components import components
from tape_audit.operators.staging import stage

WORDS = 3
SEED = 42
DISTANCE = 3
SEGMENTS = 2
BLOCK = 1024


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, in the order of the bits. Eight counters share a word, so that up to 255
    hashes are added at once."""
    padded = np.concatenate([hashes, np.zeros(-len(hashes) % 255, np.uint64)]).reshape(-1, 255)
    each = np.uint64(0x0101010101010101)
    sums = [((padded >> np.uint64(i)) & each).sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64) for i in range(8)]
    return np.stack(sums, axis=1).ravel()


def fingerprint(raw: bytes | None, words: int = WORDS) -> int:
    """Fingerprint of one text: lower-case A-Z, words split on ASCII white space, majority of each hash bit over the
    shingles with their repeats. A shorter text is one shingle; a text without words, or null, is zero."""
    parts = raw.lower().split() if raw else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip((ends - lengths).tolist(), ends[words - 1 :].tolist(), strict=False)]
    majority = 2 * _ones(np.array(hashes, np.uint64)) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.fromiter(map(fingerprint, raw_texts(texts)), np.uint64, len(texts)).view(np.int64))


def simhash(text: Column | str) -> Column:
    """Fingerprint of a text column as a signed long."""
    return F.arrow_udf(_fingerprints, "long")(text)


def _variants(fp: Column) -> Column:
    """Index entries of a fingerprint: (key, side). Key 0 of a segment is the segment itself, the others have one bit
    wildcarded; side is that bit's value."""
    width = 64 // SEGMENTS
    entries = []
    for segment in range(SEGMENTS):
        part = F.shiftrightunsigned(fp, segment * width).bitwiseAND(F.lit((1 << width) - 1))
        for slot in range(width + 1):
            tag = F.lit((segment * (width + 1) + slot) << width)
            bit = F.lit(1 << (slot - 1)) if slot else F.lit(0)
            entries.append(F.struct(
                part.bitwiseAND(F.bitwise_not(bit)).bitwiseOR(tag).alias("key"),
                (part.bitwiseAND(bit) != 0).alias("side"),
                F.lit(slot == 0).alias("whole"),
            ))
    return F.array(*entries)


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links (member, root) that span the verified neighbourhoods among the members."""
    links, left = [], np.unique(members)
    while len(left) > 1:
        root, queue = left[0], [left[0]]
        left = left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= DISTANCE
            if near.any():
                found = left[near]
                links += [(f, root) for f in found]
                queue += list(found)
                left = left[~near]
    return links


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (key, i, j): the forest of each group; a group may span batches."""
    def flush(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        links = [x for part in np.split(fps, cuts) if len(part) > 1 for x in _forest(part)]
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    key, fps = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        column = lambda name, b=batch: b.column(name).to_numpy(zero_copy_only=False)
        key = np.concatenate([key, np.stack([column("key"), column("i").astype(np.int64), column("j").astype(np.int64)], axis=1)])
        fps = np.concatenate([fps, column("fp").view(np.uint64)])
        last = int(np.flatnonzero((key != key[-1]).any(axis=1))[-1]) + 1 if (key != key[-1]).any() else 0
        if last:
            yield flush(key[:last], fps[:last])
            key, fps = key[last:], fps[last:]
    if len(fps):
        yield flush(key, fps)


def near_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose transitive closure equals that of all pairs of ``fps`` (distinct longs, column fp) within
    three bits."""
    tasks = max(fps.rdd.getNumPartitions(), fps.sparkSession.sparkContext.defaultParallelism)  # an entry for each bit follows
    index = fps.repartition(tasks, "fp").select("fp", F.explode(_variants(F.col("fp"))).alias("e")).select("fp", "e.*")
    crowded = index.groupBy("key").agg(
        F.count("*").alias("n"), F.count_if("side").alias("n1"), F.first("whole").alias("whole"),
    ).where("(whole and n > 1) or (n1 > 0 and n1 < n)")
    crowded = stage(crowded.select("key", "whole", *(
        F.ceil(F.col(c) / block).cast("int").alias(f"b_{c}") for c in ("n", "n1")
    ), F.ceil((F.col("n") - F.col("n1")) / block).cast("int").alias("b_n0")), "variants")
    dealt = index.drop("whole").join(crowded, "key").select(
        "key", "fp", "side", "whole", "b_n", "b_n0", "b_n1",
        F.pmod(F.xxhash64("fp"), F.when(F.col("whole"), F.col("b_n")).when(F.col("side"), F.col("b_n1")).otherwise(F.col("b_n0"))).cast("int").alias("mine"),
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("whole"), F.col("b_n")).when(F.col("side"), F.col("b_n0")).otherwise(F.col("b_n1")) - 1)))
    i = F.when(F.col("whole"), F.least("mine", "other")).when(F.col("side"), F.col("other")).otherwise(F.col("mine"))
    j = F.when(F.col("whole"), F.greatest("mine", "other")).when(F.col("side"), F.col("mine")).otherwise(F.col("other"))
    groups = dealt.select("key", i.alias("i"), j.alias("j"), "fp").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return groups.mapInArrow(_spans, "a long, b long")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    component_id is the least doc_id reachable over links of at most three differing bits. Null and empty texts have
    fingerprint zero and link like any other. Rows repeated, or tied in doc_id, each give their row; a row without
    doc_id takes part, and a component without any doc_id has none as its id.
    """
    marked = stage(docs.select("doc_id", simhash("text").alias("fp")), "fingerprints")
    classes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), block)).withColumnRenamed("node", "fp")
    placed = stage(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(placed.join(ids, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
