"""Spelling variants: words one edit apart, found over variable-length grams.

Words are counted over all documents. A gram starts at every place of a word (between a mark before and a mark behind it)
and grows from two code points while it is frequent, up to five; the dictionary of frequent grams comes from the counts of
all words and is pruned by frequency, so that its size is bounded. What gram starts at a place hangs on the gram's own
code points only. So an edit changes just the grams that cover it, and a word knows how many that can be at most: the
affected-gram bound b. Two words one edit apart share all but b grams of either. In one order of all grams, rarest first,
they therefore share one among the first b + 1 of each. Only those lists are merged, keyed by gram, place and word length:
a shared gram stands at the same place, or one further behind an inserted code point. Each pair is verified.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tape_audit.llm.token_files import text_runs
from tape_audit.operators.staging import stage

RUN = "A-Za-zÀ-ÿ"
SHORTEST = 5  # code points of a word; at least the longest gram
LEAST = 3  # occurrences of a word
ODDS = 97  # of a run to lose a code point
SHORT_GRAM, LONG_GRAM = 2, 5
DICTIONARY = 1 << 18  # grams at most
FREQUENT = 64  # words at least of a gram in the dictionary
TIMES = 2  # a form is so much more frequent
LONG_RUN = 64  # bytes; longer runs are hashed one by one
ENDS = "^$"

_TABLE = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)


def _crc32(starts: np.ndarray, runs: pa.Array) -> np.ndarray:
    """crc32 of every run, going on from the crc32 of what stands before it."""
    offsets = np.frombuffer(runs.buffers()[1], np.int64)[runs.offset : runs.offset + len(runs) + 1]
    data, sizes = np.frombuffer(runs.buffers()[2] or b"", np.uint8), np.diff(offsets)
    state, at = ~starts.astype(np.uint32), 0
    going = np.flatnonzero((sizes > 0) & (sizes <= LONG_RUN))
    while len(going):
        now = state[going]
        state[going] = _TABLE[(now ^ data[offsets[going] + at]) & 255] ^ (now >> 8)
        at += 1
        going = going[sizes[going] > at]
    out = ~state
    for i in np.flatnonzero(sizes > LONG_RUN):
        out[i] = zlib.crc32(data[offsets[i] : offsets[i + 1]], int(starts[i]))
    return out


def _counted(batches: Iterator[pa.RecordBatch], shortest: int, odds: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in text_runs(batch.column("text")):
            ids = batch.column("doc_id").slice(at, len(texts)).to_pylist()
            at += len(texts)
            parts = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.large_string()), ""), f"[^{RUN}]+")
            document = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
            wanted = pc.greater_equal(pc.utf8_length(parts.flatten()), shortest)
            runs, document = pc.ascii_lower(parts.flatten().filter(wanted)), document[wanted.to_numpy(zero_copy_only=False)]
            before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            h = _crc32(before[document], runs)
            lost = h % odds == 0
            cut = [w[: (p := k % len(w))] + w[p + 1 :] for w, k in zip(runs.filter(pa.array(lost)).to_pylist(), h[lost].tolist(), strict=True)]
            for words in (runs.filter(pa.array(~lost)), pa.array([w for w in cut if len(w) >= shortest], pa.large_string())):
                found = words.value_counts()
                yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], ["word", "n"])


def words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, odds: int = ODDS) -> DataFrame:
    """(word, n) of the distinct words of ``docs`` that occur ``least`` times, as the module's rule makes them."""
    found = docs.select("doc_id", "text").mapInArrow(lambda b: _counted(b, shortest, odds), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all grams of the words of a batch."""
    for batch in batches:
        counts: Counter[str] = Counter()
        for word in batch.column("word").to_pylist():
            text = f"{ENDS[0]}{word}{ENDS[1]}"
            for size in range(SHORT_GRAM, LONG_GRAM + 1):
                counts.update(text[i : i + size] for i in range(len(text) - size + 1))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["gram", "n"])


def dictionary(words: DataFrame, most: int = DICTIONARY, frequent: int = FREQUENT) -> dict[str, int]:
    """Frequent grams and their counts, at most ``most``: a gram is frequent above a share of all places that grows with
    them, and no more than ``most`` grams can be."""
    grams = stage(words.select("word").mapInArrow(_spans, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    places = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {r[0]: r[1] for r in grams.where(F.col("n") > max(frequent, -(-places // most))).collect()}


def grams_of(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram that starts at each place of the word between its end marks."""
    text = f"{ENDS[0]}{word}{ENDS[1]}"
    out = []
    for i in range(len(text) - SHORT_GRAM + 1):
        size = SHORT_GRAM
        while text[i : i + size] in frequent and size < LONG_GRAM and i + size < len(text):
            size += 1
        out.append(text[i : i + size])
    return out


def affected(grams: list[str]) -> int:
    """The most grams that cover one code point: what one edit can change."""
    cover = [0] * (len(grams) + LONG_GRAM)
    for i, gram in enumerate(grams):
        for k in range(i, i + len(gram)):
            cover[k] += 1
    return max(cover[1 : len(grams)], default=0)


def _lists(batches: Iterator[pa.RecordBatch], frequent: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """The rarest grams of each word, one more than an edit can change."""
    for batch in batches:
        names, places, which = [], [], []
        found = batch.column("word").to_pylist()
        for k, word in enumerate(found):
            grams = grams_of(word, frequent)
            for _, gram, i in sorted((frequent.get(g, 0), g, i) for i, g in enumerate(grams))[: affected(grams) + 1]:
                names.append(gram)
                places.append(i)
                which.append(k)
        of = pa.array(which, pa.int32())
        size = pa.array([len(w) for w in found], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int32()), *(c.take(of) for c in (size, batch.column("word"), batch.column("n")))], ["gram", "place", "size", "word", "n"])


def near_pairs(words: DataFrame, most: int = DICTIONARY, frequent: int = FREQUENT) -> DataFrame:
    """(a, b, a_n, b_n) of every two words one edit apart, each pair once; ``words`` are distinct (word, n)."""
    known = words.sparkSession.sparkContext.broadcast(dictionary(words, most, frequent))
    lists = stage(words.select("word", "n").mapInArrow(lambda b: _lists(b, known.value), "gram string, place int, size int, word string, n long"), "gram-lists")
    key = lambda place, size: F.xxhash64("gram", place, size)
    place, size = F.col("place"), F.col("size")
    one = F.lit(1)
    asked = lists.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(F.array(key(place, size), key(place, size + one), key(place + one, size + one))).alias("key"), size.alias("a_size"))
    listed = lists.select(key(place, size).alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"), size.alias("b_size"))
    once = (F.col("a_size") < F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a") < F.col("b")))
    found = asked.join(listed, "key").where(once & (F.levenshtein("a", "b", 1) == 1))
    return found.select("a", "b", "a_n", "b_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each round doubles the steps taken. Every step at least doubles a word's count, so
    six rounds reach the end of any chain of counts that fit a long."""
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return at


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, odds: int = ODDS, times: int = TIMES, most: int = DICTIONARY, frequent: int = FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text; other columns are ignored).

    Runs of letters of whole texts, A-Z lower-cased, are words; of a run whose hash with its document's id ``odds`` divides,
    one code point is lost. Null and empty texts have no words; a null doc_id is hashed as nothing. Rows that repeat a
    doc_id or a text count each. ``form`` is the near word of the largest n (ties: the first in code-point order) where that
    is at least ``times`` the word's, else null; ``root`` follows forms to the last. No words, no rows.
    """
    if shortest < LONG_GRAM or times < 2:
        raise ValueError("words must be as long as the longest gram, and forms twice as frequent, for whole results")
    known = stage(words(docs, shortest, least, odds), "words")
    pairs = near_pairs(known, most, frequent)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    near = pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best = known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.less") >= times * F.col("n"), F.col("best")).alias("best"))
    found = stage(best.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
