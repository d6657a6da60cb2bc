"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label. Every passage is encoded by the shape of its text: how
often each class of character follows each other one, how words repeat and how long they are. A hidden layer turns
that into a representation; a gated attention, tanh times sigmoid, weighs the passages of a document, and a logistic
unit scores the weighted sum. Attention and representation are learned together from document labels.

Training is data-parallel: bags are stored in shards, each task descends from the current parameters over its own
shard, and the parameters are averaged after every round. The driver sees parameters only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.llm.buffers import raw_texts
from tape_audit.llm.language import held_out
from tape_audit.operators.staging import stage

PASSAGE = 48  # words
TRAIN_ROWS = 16_000  # labelled rows that the model is fitted on, about; a hash of the id chooses them
SHARDS = 8
ROUNDS, EPOCHS, BATCH, RATE = 6, 3, 32, 0.01
HIDDEN, GATE = 24, 12
CUT = 0.3  # score from which a document is predicted good
AT_ONCE = 20_000  # passages scored at once

#: Classes of bytes: white space, line ends, lower case, upper case, digits, sentence marks, other ASCII, beyond ASCII.
_CLASS = np.full(256, 6, np.int64)
_CLASS[[9, 11, 12, 32]], _CLASS[[10, 13]], _CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3, 4, 7
_CLASS[[ord(c) for c in ".,;:'\"-?"]] = 5
WIDTH = 64 + 6


def encode(raw: bytes | None) -> np.ndarray:
    """A row of ``WIDTH`` numbers for each passage; a text without words is one passage of zeros."""
    words = raw.split() if raw else []
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    n = -(-len(words) // PASSAGE)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    kinds = _CLASS[np.frombuffer(b" ".join(words), np.uint8)]
    ends = np.cumsum(lengths + 1)
    sizes = np.diff(np.concatenate([[0], ends[PASSAGE - 1 : -1 : PASSAGE], ends[-1:] - 1])) if n > 1 else ends[-1:] - 1
    passage = np.repeat(np.arange(n), sizes)
    pairs = np.bincount(passage[1:] * 64 + kinds[:-1] * 8 + kinds[1:], minlength=n * 64).reshape(n, 64)
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :64] = pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    ids = np.fromiter(map(hash, words), np.int64, len(words))  # only compared within the text
    starts = np.arange(0, len(words), PASSAGE)
    counts = np.diff(np.concatenate([starts, [len(words)]]))
    for i, lag in enumerate((1, 2, 3)):
        same = np.zeros(len(words))
        same[lag:] = ids[lag:] == ids[:-lag]
        out[:, 64 + i] = np.add.reduceat(same, starts) / counts
    order = np.lexsort((ids, np.repeat(np.arange(n), counts)))
    new = np.ones(len(words))
    new[1:] = ids[order][1:] != ids[order][:-1]
    new[starts] = 1
    out[:, 67] = np.add.reduceat(new, starts) / counts
    out[:, 68] = np.add.reduceat(lengths, starts) / counts / 10
    out[:, 69] = counts / PASSAGE
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]  # hidden layer, its offset, tanh gate, sigmoid gate, attention, output, its offset

    @staticmethod
    def new(mean: np.ndarray, scale: np.ndarray) -> Network:
        rng = np.random.default_rng(5)
        shapes = ((WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,))
        return Network(mean, scale, [rng.standard_normal(s) / np.sqrt(s[0]) if i not in (1, 6) else np.zeros(s) for i, s in enumerate(shapes)])

    def _forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple:
        w, b, v, u, att, c, c0 = self.weights
        starts = np.cumsum(sizes) - sizes
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ w + b)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        e = (t * s) @ att
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, s, a, z, 1 / (1 + np.exp(-np.clip(z @ c + c0, -30, 30)))

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self._forward(x, sizes)[-1]

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        _, _, v, u, att, c, _ = self.weights
        h, t, s, a, z, p = self._forward(x, sizes)
        starts = np.cumsum(sizes) - sizes
        d = (p - y) / len(y)
        dz = np.repeat(d[:, None] * c, sizes, axis=0)
        da = (h * dz).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dt, ds = (de[:, None] * att) * s * (1 - t * t), (de[:, None] * att) * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ v.T + ds @ u.T) * (1 - h * h)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d, d.sum(keepdims=True)]

    def descend(self, bags: list[tuple[np.ndarray, float]], seed: int) -> list[np.ndarray]:
        """Adam over shuffled batches of bags; the parameters it ends with."""
        rng, step = np.random.default_rng(seed), 0
        self.weights = [w.copy() for w in self.weights]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                own = [bags[k] for k in order[i : i + BATCH]]
                grads = self.gradients(np.concatenate([b for b, _ in own]).astype(np.float64), np.array([len(b) for b, _ in own]), np.array([y for _, y in own]))
                step += 1
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self.weights


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [encode(raw).tobytes() for raw in raw_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "bag"])


def _read(batches: Iterator[pa.RecordBatch]) -> list[tuple[np.ndarray, float]]:
    return [(np.frombuffer(b, np.float32).reshape(-1, WIDTH), float(y)) for batch in batches
            for b, y in zip(batch.column("bag").to_pylist(), batch.column("label").to_pylist(), strict=True)]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network | None:
    """Fits on labelled documents outside the held-out fold; None where there are none."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    n = known.count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / (1 << 20)
    chosen = known.where(chance < rows / max(n, 1)).select("doc_id", F.col("quality").alias("label"))  # about ``rows`` rows
    bags = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_bags, "doc_id long, label int, bag binary")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(SHARDS))
    bags = stage(bags.repartition(SHARDS, shard).sortWithinPartitions("doc_id", "label", "bag"), "bags").withColumn("shard", shard)

    def each(work):  # noqa: ANN001, ANN202
        """The results of a task for each shard: a few arrays."""
        def run(key: tuple, table: pa.Table) -> pa.Table:
            got = work(int(key[0].as_py()), sorted(_read(table.to_batches()), key=lambda b: (b[1], b[0].tobytes())))
            return pa.table({"n": pa.array([table.num_rows]), "out": pa.array([np.concatenate([np.ravel(g) for g in got]).tobytes()], pa.binary())})

        return [(r["n"], np.frombuffer(r["out"])) for r in bags.groupBy("shard").applyInArrow(run, "n long, out binary").collect()]

    sums = each(lambda _, own: [np.array([float(sum(len(b) for b, _ in own))]), sum(b.sum(axis=0, dtype=np.float64) for b, _ in own), sum((b.astype(np.float64) ** 2).sum(axis=0) for b, _ in own)])
    if not sums:
        return None
    total = sum(s for _, s in sums)
    mean = total[1 : WIDTH + 1] / total[0]
    network = Network.new(mean, np.sqrt(np.maximum(total[WIDTH + 1 :] / total[0] - mean**2, 1e-6)))
    for r in range(ROUNDS):
        got = each(lambda shard, own, r=r: network.descend(own, r * SHARDS + shard))
        flat = sum(n * w for n, w in sorted(got, key=lambda x: x[1].tobytes())) / sum(n for n, _ in got)
        cuts = np.cumsum([w.size for w in network.weights])[:-1]
        network = Network(network.mean, network.scale, [p.reshape(w.shape) for p, w in zip(np.split(flat, cuts), network.weights, strict=True)])
    return network


def quality(network: Network | None, text: Column | str) -> Column:
    """Score of a text column; the network is a few thousand numbers and travels with the function."""
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out: list[float] = []
            waiting: list[np.ndarray] = []
            passages = 0
            for raw in raw_texts(texts):
                waiting.append(encode(raw))
                passages += len(waiting[-1])
                if passages >= AT_ONCE:
                    out += flush(waiting)
                    waiting, passages = [], 0
            yield pa.array(out + flush(waiting), pa.float64())

    def flush(bags: list[np.ndarray]) -> list[float]:
        if not bags:
            return []
        return network.score(np.concatenate(bags), np.array([len(b) for b in bags])).tolist() if network else [0.5] * len(bags)

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scored, "double")(text)


def scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id,
    quality); other columns are ignored.

    Null and empty texts are scored as one passage of zeros, a very long text by all its passages. Without any label
    every score is 0.5. Rows repeated or without doc_id each give their row; a label repeated counts again.
    """
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality(fit(docs, labels, rows), "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
