"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors are stored once as blocks of rows. Let C be their matrix with the mean of each dimension taken away.
Each step is two passes of Spark tasks over the blocks: one multiplies C with a right vector and measures the result
against all left vectors so far, the other multiplies the transposed C with the new left vector. Every task adds up its
own blocks, and Spark adds the tasks' sums, so a pass returns a few numbers for each dimension. A left vector has as many
entries as there are rows; it never leaves the tasks, which rebuild it as C times a short vector of coefficients. Right
vectors are kept orthogonal to all earlier ones on the driver, left ones by the measured products: full
reorthogonalisation on both sides. The singular values and vectors of the small bidiagonal matrix give the components.

One start vector finds one vector of a repeated singular value. So after the first run others follow on what is
orthogonal to the components found, until a run finds nothing above the least of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.operators.staging import stage

SCALE = 256
COMPONENTS = 4
CLOSE = 1e-15  # residual of a component, as a share of the largest singular value
SEEN = 1e-6  # the same in a run that only looks whether something is left
LEAST = 1e-10  # smaller singular values, as a share of the largest, are rounding
LARGEST = (1 << 63) - 1

Part = tuple[np.ndarray, np.ndarray]


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def _rows(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, ending in zeros where they are shorter than ``width``."""
    offsets = column.offsets.to_numpy()
    sizes, values = np.diff(offsets), column.values.to_numpy()[offsets[0] : offsets[-1]]
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def _packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A batch of vectors as one block, in as few bytes as its values allow."""
    for batch in batches:
        rows = _rows(batch.column("x"), width)
        if rows.size:
            kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= rows.min() and rows.max() <= np.iinfo(k).max)
            yield pa.RecordBatch.from_pydict({"kind": [kind], "rows": pa.array([rows.astype(kind).tobytes()], pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, raw in zip(batch.column("kind").to_pylist(), batch.column("rows"), strict=True):
            yield np.frombuffer(raw.as_buffer(), kind).reshape(-1, width)


def _totals(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of each dimension; the place behind the last holds the number of rows."""
    sums = [0] * (width + 1)
    for rows in _blocks(batches, width):
        safe = max(abs(int(rows.min())), abs(int(rows.max()))) < (1 << 62) // len(rows)
        part = (rows.astype(np.int64) if safe else rows.astype(object)).sum(axis=0).tolist()
        sums = [a + b for a, b in zip(sums, [*part, len(rows)], strict=True)]
    yield pa.RecordBatch.from_pydict({"place": list(range(width + 1)), "total": [str(s) for s in sums]}, pa.schema([("place", pa.int32()), ("total", pa.string())]))


class Centred:
    """The distinct vectors less their mean, as stored blocks: products with them are passes of Spark tasks."""

    def __init__(self, distinct: DataFrame, width: int) -> None:
        self.width = width
        self.blocks = stage(distinct.mapInArrow(lambda b: _packed(b, width), "kind string, rows binary"), "vector-blocks")
        totals = self.blocks.mapInArrow(lambda b: _totals(b, width), "place int, total string")
        whole = {r[0]: int(r[1]) for r in totals.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect()}
        self.n, self.sums = whole[width], [whole[i] for i in range(width)]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(width)

    def _pass(self, product: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all blocks of ``product`` of a centred block, a vector of ``size``."""
        width, mean = self.width, self.mean

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for rows in _blocks(batches, width):
                out += product(rows - mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(out)], ["place", "part"])

        parts = self.blocks.mapInArrow(tasks, "place int, part double").groupBy("place").agg(F.sum("part"))
        out = np.zeros(size)
        for place, part in parts.collect():
            out[place] = part
        return out

    def measured(self, basis: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Products of C ``right`` with each C ``basis`` column and with itself."""
        both = np.column_stack([basis, right])
        return self._pass(lambda c: (w := c @ both).T @ w[:, -1], both.shape[1])

    def transposed(self, basis: np.ndarray, left: np.ndarray) -> Part:
        """Transposed C times u, where u is C ``left``, and the products of u with each C ``basis`` column."""
        both = np.column_stack([basis, left])
        got = self._pass(lambda c: np.concatenate([c.T @ (w := c @ both)[:, -1], w[:, :-1].T @ w[:, -1]]), self.width + basis.shape[1])
        return got[: self.width], got[self.width :]

    def spread(self) -> float:
        """The sum of squares of all entries."""
        return float(self._pass(lambda c: np.array([np.einsum("ij,ij", c, c)]), 1)[0])

    def identity_error(self, whiten: np.ndarray) -> float:
        """Largest absolute entry of the covariance of C ``whiten`` less the identity."""
        k = whiten.shape[1]
        got = self._pass(lambda c: np.concatenate([(w := c @ whiten).sum(axis=0), (w.T @ w).ravel()]), k + k * k) / self.n
        return float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())


def _apart(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` without what lies along the basis; the second turn removes what rounding left."""
    for _ in range(2):
        for b in basis:
            v = v - b * (b @ v)
    return v


def bidiagonalise(c: Centred, fixed: list[np.ndarray], want: int, known: float) -> list[tuple[float, np.ndarray]]:
    """(singular value, right vector) of the largest ``want`` on what is orthogonal to ``fixed``, falling; all that a run
    can reach where it ends earlier. Runs with ``fixed`` vectors end early when nothing above ``known`` is in sight."""
    start = np.random.default_rng(len(fixed)).standard_normal(c.width)
    v = _apart(start / np.linalg.norm(start), fixed)
    norm = np.linalg.norm(v)
    rights: list[np.ndarray] = []
    lefts, diagonal, above = np.zeros((c.width, 0)), [], []  # the left vectors are C times the columns of lefts
    values, inner, ends = np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    while norm > 0 and len(rights) < c.width - len(fixed):
        rights.append(v := v / norm)
        y = v - above[-1] * lefts[:, -1] if above else v
        got = c.measured(lefts, y)
        y, length = y - lefts @ got[:-1], math.sqrt(max(0.0, got[-1] - got[:-1] @ got[:-1]))
        top = max([length, known, *diagonal])
        if length <= LEAST * top:  # the left space is complete: v adds nothing to it
            small = np.zeros((len(diagonal), len(rights)))
        else:
            z, off = c.transposed(lefts, y / length)
            y = y / length - lefts @ off
            lefts, diagonal = np.column_stack([lefts, y]), [*diagonal, length]
            small = np.zeros((len(diagonal), len(diagonal)))
        for i, d in enumerate(diagonal):
            small[i, i] = d
            if i + 1 < small.shape[1]:
                small[i, i + 1] = above[i]
        ends_at, values, inner = np.linalg.svd(small)
        if length <= LEAST * top:
            break
        v = _apart(z - length * rights[-1], [*fixed, *rights])
        norm = float(np.linalg.norm(v))
        ends = norm * np.abs(ends_at[-1])
        if norm <= 1e-14 * top or (len(values) >= want and (ends[:want] <= CLOSE * top).all()):
            break
        if fixed and values[0] <= known and ends[0] <= SEEN * top:
            break
        above.append(norm)
    found = [(float(s), np.column_stack(rights) @ inner[i]) for i, s in enumerate(values[:want])] if rights else []
    return [(s, r / np.linalg.norm(r)) for s, r in found]


def components(c: Centred, most: int = COMPONENTS) -> list[tuple[float, np.ndarray]]:
    """The largest ``most`` (singular value, right vector) of C, falling; fewer where C has a smaller rank."""
    found: list[tuple[float, np.ndarray]] = []
    while len(found) < c.width:
        known = found[most - 1][0] if len(found) >= most else 0.0
        more = [(s, r) for s, r in bidiagonalise(c, [r for _, r in found], most, known) if s > LEAST * max([s for s, _ in found], default=0.0) and s > known]
        if not more:
            break
        found = sorted([*found, *more], key=lambda x: -x[0])
    return found[:most]


def _projected(batches: Iterator[pa.RecordBatch], width: int, n: int, sums: list[int], mean: np.ndarray, whiten: np.ndarray, explained: list[float], error: float) -> Iterator[pa.RecordBatch]:
    k = whiten.shape[1]
    for batch in batches:
        rows = _rows(batch.column("x"), width)
        white = (rows - mean) @ whiten
        deviation = pa.array(np.repeat(_deviations(rows, n, sums, mean), k).tolist(), pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(rows)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
            pa.array(np.full(len(rows) * k, n)), deviation, pa.array(white.ravel()), pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(rows) * k, error))],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def _deviations(rows: np.ndarray, n: int, sums: list[int], mean: np.ndarray) -> np.ndarray:
    """Sums of (n x - S)^2, exact; None where a long can't hold one."""
    far = n * max(abs(int(rows.min())), abs(int(rows.max()))) + max(map(abs, sums)) if rows.size else 0
    if rows.shape[1] * far * far <= LARGEST:
        return ((rows * n - np.array(sums, np.int64)) ** 2).sum(axis=1).astype(object)
    out = np.full(len(rows), None, object)
    for i in np.flatnonzero(((rows - mean) ** 2).sum(axis=1) * float(n) * n < 1.01 * LARGEST):
        total = sum((n * x - s) ** 2 for x, s in zip(rows[i].tolist(), sums, strict=True))
        out[i] = total if total <= LARGEST else None
    return out


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row of ``vectors`` (vec_id,
    embedding; other columns are ignored) and each of the ``most`` largest components.

    Vectors that are null or hold null or non-finite entries take no part; entries become floor(256 x), at most a long.
    Shorter vectors count as ending in zeros. Every row gets its own result, also without vec_id or where it repeats one,
    but components are fitted to each distinct vector once. Components of a variance that is rounding only (``LEAST``) are
    left out, so equal vectors, a single one or none give no rows. ``deviation`` is null where a long can't hold it.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    used = stage(vectors.where("embedding is not null").where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")), "whole-vectors")
    width = used.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    c = Centred(used.select(filled.alias("x")).groupBy("x").agg(F.count("*").alias("rows")).select("x"), width) if width else None
    found = components(c, most) if c else []
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not found:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, mean, trace = c.n, c.sums, c.mean, c.spread()
    white = np.column_stack([r * math.sqrt(n) / s for s, r in found])
    explained, error = [s * s / trace for s, _ in found], c.identity_error(white)
    return used.mapInArrow(lambda b: _projected(b, width, n, sums, mean, white, explained, error), schema)
