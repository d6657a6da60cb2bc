"""Best-fit packing of documents into sequences, planned over the histogram of lengths.

Every document is encoded once; tasks cut it into pieces of at most ``capacity`` tokens and store them. Spark counts the
pieces of each length, so the plan is made over at most ``capacity`` counts, never over documents: lengths fall, and the
equal pieces of a length go to the open sequences with the least room that still holds them, whole runs of equal sequences
at a time. Pieces then take the planned slots by a join on their rank within their length. Ranks are counted in blocks of
bounded size, so a length that a third of all pieces have is spread over all its blocks.

Runs of equal sequences split at most twice for each length and take at most 63 different lengths, so the plan has a bound
that follows from the capacity alone, whatever the input; that makes its broadcast safe.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.llm.token_files import encoder_of, text_runs, with_end
from tape_audit.operators.staging import stage

CAPACITY = 2048
END_ID = 0
BLOCK = 1 << 16  # pieces of a task whose ranks are counted together

PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, block long"
SLOTS = "length long, first long, bins long, each long, sequence long, offset long"


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, by_word: bool, capacity: int, end_id: int, block: int) -> Iterator[pa.RecordBatch]:
    encoder, made, task = encoder_of(tokenizer, by_word), 0, TaskContext.get().partitionId()
    width = array(encoder.type).itemsize
    for batch in batches:
        at = 0
        for texts in text_runs(batch.column("text")):
            ids, counts = with_end(*encoder.batch(texts), end_id)
            pieces = -(-counts // capacity)
            number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(np.repeat(counts, pieces) - number * capacity, capacity)
            ends = np.cumsum(length)
            crc = [zlib.crc32(ids[b - n : b].astype("<u4").tobytes()) for b, n in zip(ends.tolist(), length.tolist(), strict=True)]
            offsets = np.concatenate(([0], ends * width)).astype(np.int32)
            raw = ids.astype(f"<u{width}", copy=False).tobytes()
            group = (task << 32) + (made + np.arange(len(number))) // block
            documents = batch.column("doc_id").slice(at, len(texts)).take(pa.array(np.repeat(np.arange(len(texts)), pieces)))
            yield pa.RecordBatch.from_arrays([
                documents.cast(pa.int64()), pa.array(number, pa.int32()), pa.array(number * capacity), pa.array(length),
                pa.Array.from_buffers(pa.binary(), len(number), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]),
                pa.array(crc, pa.int64()), pa.array(group)], ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "block"])
            at, made = at + len(texts), made + len(number)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, bins, each, sequence, offset): of the pieces of ``length``, those ranked from ``first`` fill ``bins``
    sequences from number ``sequence`` on, ``each`` to a sequence, from ``offset`` on. Best fit by falling length."""
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> runs (first sequence, how many)
    slots, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def take(room: int, first: int, bins: int) -> None:
            """Fill the sequences of a run in order; what stays untouched goes back."""
            nonlocal left, rank
            each = room // length
            full = min(bins, left // each)
            for n, many in ((full, each), (min(1, bins - full), left - full * each if bins > full else 0)):
                if n and many:
                    slots.append((length, rank, n, many, first, capacity - room))
                    rooms[room - many * length].append((first, n))
                    left, rank, first, bins = left - n * many, rank + n * many, first + n, bins - n
            if bins:
                rooms[room].append((first, bins))

        for room in sorted(r for r, runs in rooms.items() if r >= length and runs):
            runs, rooms[room] = rooms[room], []
            while runs and left:
                take(room, *runs.pop())
            rooms[room] += runs
        if left:
            new = -(-left // (capacity // length))
            first, made = made, made + new
            take(capacity, first, new)
    return slots


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, by_word: bool = False, block: int = BLOCK) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset): the pieces of every row of ``docs`` (doc_id,
    text; other columns are ignored), each with its place in a sequence of at most ``capacity`` tokens.

    A document is its ids and the end id; only one longer than the capacity is cut, and all its pieces but the last are
    full. ``ids`` holds them little-endian in two bytes where the vocabulary allows it, else in four; ``ids_crc32`` is over
    four bytes each. Null and empty texts are the end id alone. Rows without doc_id and rows that repeat one are documents
    of their own. Which of equally long pieces takes which slot follows the stored order of rows. No documents, no pieces.
    ``by_word`` is for tokenizers that lower-case and drop white space.
    """
    spark = docs.sparkSession
    pieces = stage(docs.select("doc_id", "text").mapInArrow(lambda b: _cut(b, tokenizer, by_word, capacity, end_id, block), PIECES), "pieces")
    groups = stage(pieces.groupBy("length", "block").count(), "piece-counts")
    counts = {r[0]: r[1] for r in groups.groupBy("length").agg(F.sum("count")).collect()}  # at most ``capacity`` rows
    slots = spark.createDataFrame(plan(counts, capacity), SLOTS)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "block"]).withColumn("rank", F.col("rank") + F.col("base"))
    slot = F.broadcast(slots.select(F.col("length").alias("slot_length"), "first", "bins", "each", "sequence", F.col("offset").alias("slot_offset")))
    inside = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("bins") * F.col("each"))
    at = F.col("rank") - F.col("first")
    return ranked.join(slot, inside).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("slot_offset") + at % F.col("each") * F.col("length")).alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, members) of packed pieces: the ids of a sequence in one value, and its documents in
    order with their offsets. A sequence has at most ``capacity`` tokens, so its group is bounded."""
    member = F.struct("offset", "length", "doc_id", "piece", "start", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(member)).alias("rows"))
    return rows.select(
        "sequence_id", "length",
        F.aggregate("rows", F.lit(b""), lambda done, r: F.concat(done, r["ids"])).alias("ids"),
        F.transform("rows", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["piece"].alias("piece"), r["start"].alias("start"), r["offset"].alias("offset"), r["length"].alias("length"))).alias("members"))
