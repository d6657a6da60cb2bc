"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has a fixed number of cells. A row falls on a cell by its key's hash and belongs to the shard of the next
virtual node clockwise. A shard takes the rows of its cells up to its capacity, cells in an order that hashing fixes;
what overflows goes on clockwise to the next virtual node whose shard has room. Rows are only counted per cell to
decide this: the plan works on at most ``CELLS`` counts, and it comes back as ranges of ranks inside cells. So no
shard and no row passes through one task, and balance is as exact as the capacities.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.operators.staging import stage

CELLS = 1 << 14
NODES = 64  # virtual nodes of a shard
SHARDS = 24


@dataclass(frozen=True)
class Range:
    """Rows of a cell from rank ``low`` to below ``high`` go to ``shard``, at slots from ``slot``."""

    cell: int
    low: int
    high: int
    shard: int
    slot: int


def _hash(*parts: object) -> int:
    return zlib.crc32("/".join(map(str, parts)).encode())


def ring(shards: int, nodes: int = NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of each virtual node, clockwise. A node on a taken cell moves to the next free one."""
    taken: dict[int, int] = {}
    for shard, node in sorted(((s, n) for s in range(shards) for n in range(nodes)), key=lambda x: _hash("node", *x)):
        at = _hash("place", shard, node) % cells
        while at in taken:
            at = (at + 1) % cells
        taken[at] = shard
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Without slack the capacities sum to the rows, so that counts are at most one apart."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(counts: dict[int, int], shards: int, slack: float = 0.0, nodes: int = NODES, cells: int = CELLS) -> list[Range]:
    """Ranges of every cell, from the rows per cell."""
    points = ring(shards, nodes, cells)
    room, at, waiting = capacities(sum(counts.values()), shards, slack), 0, []
    for cell in range(cells):
        while at < len(points) and points[at][0] < cell:
            at += 1
        if counts.get(cell):
            waiting.append((cell, 0, counts[cell], at % len(points)))
    placed: list[tuple[int, int, int, int]] = []
    while waiting:
        over = []
        for cell, low, high, node in sorted(waiting, key=lambda x: (_hash("turn", x[0]), x[1])):
            shard = points[node][1]
            upto = low + min(high - low, room[shard])
            room[shard] -= upto - low
            if upto > low:
                placed.append((cell, low, upto, shard))
            if upto < high:
                over.append((cell, upto, high, node))
        waiting = []
        for cell, low, high, node in over:
            while not room[points[node][1]]:
                node = (node + 1) % len(points)
            waiting.append((cell, low, high, node))
    slots, out = [0] * shards, []
    for cell, low, high, shard in sorted(placed):
        out.append(Range(cell, low, high, shard, slots[shard]))
        slots[shard] += high - low
    return out


def shard(docs: DataFrame, shards: int = SHARDS, slack: float = 0.0, nodes: int = NODES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs`` (doc_id, text; other columns
    are ignored).

    The law is ``rows``: counts of shards differ by one at most, as long as ``slack`` is 0. Null texts count as empty.
    Rows that share a doc_id fall on one cell and take ranks by size and checksum; equal rows take neighbouring slots.
    A null doc_id has a place on the ring like any other key.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = stage(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("hash"),
    ).withColumn("cell", F.pmod("hash", F.lit(CELLS)).cast("int")), "keys")
    counts = {r["cell"]: r["count"] for r in keyed.groupBy("cell").count().collect()}  # CELLS at most
    ranges = plan(counts, shards, slack, nodes) if counts else []
    schema = "cell int, low long, high long, shard int, slot_from long"
    table = docs.sparkSession.createDataFrame([(r.cell, r.low, r.high, r.shard, r.slot) for r in ranges], schema)
    # a range for each cell and another for each time that one is cut: CELLS + shards * nodes rows at most
    order = Window.partitionBy("cell").orderBy("hash", "doc_id", "size", "text_crc32")
    ranked = keyed.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    return ranked.join(F.broadcast(table), "cell").where("rank >= low and rank < high").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot_from") + F.col("rank") - F.col("low")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
