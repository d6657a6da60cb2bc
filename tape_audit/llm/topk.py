"""Exact top-k inner products by ball-tree branch and bound over shards.

Vectors are dealt into shards of bounded size, and a task builds each shard's ball tree once and stores it. Queries
come in blocks; a task takes one block and one shard. For each query it walks the nodes in the order of their upper
bound (centre times query plus radius times the query's length) and stops where the bound falls below the k-th score
known so far. That score is shared: every query is first run against the one shard that holds its own neighbours by
hash, and the k-th score found there starts the search in all other shards.

Components are integers, and products are exact: scores are added in floating point only while they fit in 53 bits,
else as Python integers.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tape_audit.operators.staging import stage

SCALE = 256
K = 5
EVERY = 50  # queries are the rows whose id it divides
SHARD = 8192  # vectors
QUERIES = 1024  # in a block
LEAF = 128
EXACT = 1 << 53
LARGEST = (1 << 63) - 1
SLACK = 1e-9  # relative, for the rounding of bounds


class BallTree:
    """Nodes over a permuted matrix: node i covers rows ``lo[i]:hi[i]`` and has children ``left[i]``, ``left[i] + 1``
    unless that is 0. Vectors of one length only; shorter ones are filled with zeros by the caller."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        lo, hi, left, nodes = [0], [len(ids)], [0], [0]
        for i in nodes:
            own = order[lo[i] : hi[i]]
            if len(own) > LEAF:
                part = rows[own].astype(np.float64)
                far = part[np.argmax(((part - part.mean(axis=0)) ** 2).sum(axis=1))]
                along = part @ (part[np.argmax(((part - far) ** 2).sum(axis=1))] - far)
                order[lo[i] : hi[i]] = own[np.argsort(along, kind="stable")]
                middle = (lo[i] + hi[i]) // 2
                left[i] = len(lo)
                nodes += [len(lo), len(lo) + 1]
                lo, hi, left = [*lo, lo[i], middle], [*hi, middle, hi[i]], [*left, 0, 0]
        self.ids, self.rows, self.lo, self.hi, self.left = ids[order], rows[order], lo, hi, left
        floats = self.rows.astype(np.float64)
        self.centres = np.stack([floats[a:b].mean(axis=0) for a, b in zip(lo, hi, strict=True)])
        self.radii = np.array([math.sqrt(((floats[a:b] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(lo, hi, self.centres, strict=True)])
        self.least = [int(self.ids[a:b].min()) for a, b in zip(lo, hi, strict=True)]

    def _top(self, scores: np.ndarray, a: int, b: int, own: int, k: int) -> list[tuple[int, int]]:
        """The best k (score, -id) of rows ``a:b`` other than ``own``."""
        if scores.dtype == object:
            return heapq.nlargest(k, ((int(s), -int(i)) for s, i in zip(scores, self.ids[a:b], strict=True) if i != own))
        scores = np.where(self.ids[a:b] == own, -np.inf, scores)
        top = np.lexsort((self.ids[a:b], -scores))[:k]
        return [(int(scores[i]), -int(self.ids[a + i])) for i in top if scores[i] > -np.inf]

    def search(self, query: np.ndarray, own: int, k: int, floor: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The best k (score, -id) of the tree that can still be among the best k of all, given the k-th best so far."""
        best: list[tuple[int, int]] = []
        length = math.sqrt(float((query.astype(np.float64) ** 2).sum()))
        bounds = self.centres @ query.astype(np.float64) + self.radii * length
        bounds += SLACK * (np.abs(bounds) + self.radii * length + length) + SLACK
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            known = max((x for x in (floor, best[0] if len(best) == k else None) if x), default=None)
            if known and (-bound < known[0] or (math.floor(-bound) <= known[0] and -self.least[node] <= known[1])):
                if -bound < known[0]:
                    break
                continue
            if self.left[node]:
                for child in (self.left[node], self.left[node] + 1):
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.lo[node], self.hi[node]
            scores = self.rows[a:b] @ query
            for item in self._top(scores, a, b, own, k):
                if floor and item < floor:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return best


def _matrix(values: list[list[int]], width: int) -> np.ndarray:
    rows = np.zeros((len(values), width), object)
    for i, v in enumerate(values):
        rows[i, : len(v)] = v
    most = max((abs(x) for v in values for x in v), default=0)
    return rows.astype(np.float64) if most * most * max(width, 1) < EXACT and most < 1 << 26 else rows


def _trees(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: one stored tree for each."""
    def built(shard: int, ids: list[int], values: list[list[int]]) -> pa.RecordBatch:
        tree = BallTree(np.array(ids, np.int64), _matrix(values, width))
        return pa.RecordBatch.from_pydict({"shard": [shard], "tree": [pickle.dumps(tree.__dict__, protocol=5)]}, pa.schema([("shard", pa.int64()), ("tree", pa.binary())]))

    now, ids, values = None, [], []
    for batch in batches:
        for shard, i, v in zip(*(batch.column(c).to_pylist() for c in ("shard", "vec_id", "whole")), strict=True):
            if shard != now and ids:
                yield built(now, ids, values)
                ids, values = [], []
            now = shard
            ids.append(i)
            values.append(v)
    if ids:
        yield built(now, ids, values)


def _walk(key: tuple, trees: pa.Table, asked: pa.Table, k: int, width: int) -> pa.Table:
    found: list[tuple[int, int, int]] = []
    for blob in trees.column("tree").to_pylist():
        tree = BallTree.__new__(BallTree)
        tree.__dict__ = pickle.loads(blob)
        values = asked.column("whole").to_pylist()
        queries = _matrix(values, width)
        if queries.dtype != tree.rows.dtype:
            queries, tree.rows = _as_object(queries), _as_object(tree.rows)
        for own, q, score, other in zip(asked.column("vec_id").to_pylist(), queries, *(asked.column(c).to_pylist() for c in ("floor_score", "floor_id")), strict=True):
            found += [(own, -i, max(-LARGEST - 1, min(LARGEST, s))) for s, i in tree.search(q, own, k, None if score is None else (score, -other))]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ([], [], []))], schema=schema)


def _as_object(rows: np.ndarray) -> np.ndarray:
    return rows if rows.dtype == object else np.vectorize(int, otypes=[object])(rows) if rows.size else rows.astype(object)


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the best k others for every row of ``vectors`` (vec_id, embedding; other
    columns are ignored) whose vec_id ``every`` divides; ties go to the smaller vec_id.

    Vectors that are null or hold null or non-finite components, and rows without vec_id, take no part. Shorter vectors
    count as ending in zeros. Rows that repeat a vec_id are candidates each, but none of them for their own query, and
    a repeated query gives one result, that of its least vector. Scores beyond a long are cut to its range. Fewer candidates than k, fewer rows.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    used = stage(vectors.where("vec_id is not null and embedding is not null").where(finite)
                 .select("vec_id", whole_numbers(F.col("embedding")).alias("whole")), "vectors")
    n, width = used.agg(F.count("*"), F.coalesce(F.max(F.size("whole")), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard))
    place = F.pmod(F.xxhash64("vec_id", "whole"), F.lit(shards)).cast("long")
    dealt = used.withColumn("shard", place)
    trees = stage(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "vec_id")
                  .mapInArrow(lambda b: _trees(b, width), "shard long, tree binary"), "trees")
    asked = used.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("whole").alias("whole")).withColumn("home", place).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(1, math.ceil(n / every / block)))).cast("int"))
    asked = stage(asked, "queries")

    def search(queries: DataFrame) -> DataFrame:
        """One task for each (shard, block): every block of queries meets every tree that it names."""
        wanted = queries.select("shard", "block").distinct().toDF("shard", "block")
        copies = trees.join(wanted, "shard").repartition("shard", "block")
        return copies.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(
            lambda key, t, q: _walk(key, t, q, k, width), "query_id long, vec_id long, score long")

    none = F.lit(None).cast("long")
    first = stage(search(asked.select("vec_id", "whole", "block", F.col("home").alias("shard"), none.alias("floor_score"), none.alias("floor_id"))), "home")
    floors = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor_score"), F.col("vec_id").alias("floor_id"))
    others = asked.join(floors, "vec_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where("shard <> home")
    rest = search(others.select("vec_id", "whole", "block", "shard", "floor_score", "floor_id"))
    return _best(first.union(rest), k).select("query_id", "rank", "vec_id", "score")


TOP_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
  FROM (SELECT vec_id, min(w) AS w FROM v WHERE vec_id % {EVERY} = 0 GROUP BY vec_id) q, v c WHERE q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
) WHERE rank <= {K}
"""
