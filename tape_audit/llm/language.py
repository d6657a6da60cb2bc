"""Language identification by words first, with back-off to character n-grams.

A word that the model knows counts with its log frequency in each language. Any other word is covered from left to
right: at each of its characters the longest known n-gram that starts there counts, shorter ones being tried only where
longer ones are unknown, and the mean over the word stands for it. A text's score is its most likely language's
share after all words are added up.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.llm.buffers import raw_texts, released

FOLDS = 5  # one in so many documents, by checksum of its id, is held out
ROWS_PER_LANGUAGE = 2_000  # labelled rows that the model is fitted on, about; a hash of the id chooses them
WORDS, GRAMS = 40_000, 120_000  # entries of the model over all languages, the most frequent ones
LONGEST = 4
LEAST_COUNT = 3  # of a known word
SMOOTHING = 0.1
KNOWN = 200_000  # entries of a task's memory of scored words; beyond it the memory starts anew
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass
class Model:
    languages: list[str]
    rows: dict[str, int]  # words as they are, n-grams behind a control character
    weights: np.ndarray  # log frequency by row and language; the last row is for what nothing covers


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def has_letter(text: str) -> bool:
    """Whether the text holds a letter of the Unicode category L; other signs of numbers are none."""
    return any(unicodedata.category(m[0])[0] == "L" for m in _WORD.finditer(text))


def _bare(word: str) -> str:
    return word if word.isalpha() else _EDGES.sub("", word)


def _grams(word: str, longest: int) -> Iterator[str]:
    padded = f" {word} "
    for i in range(len(padded) - 1):
        for n in range(1, min(longest, len(padded) - i) + 1):
            yield "\x01" + padded[i : i + n]


@released
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for raw, lang in zip(raw_texts(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
            words = Counter(filter(None, map(_bare, (raw or b"").decode().lower().split())))
            own = counts.setdefault(lang, Counter())
            own.update(words)
            for word, n in words.items():
                for gram in _grams(word, LONGEST):
                    own[gram] += n
        rows = [(lang, key, n) for lang, own in counts.items() for key, n in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "key", "n"])


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fits on labelled documents outside the held-out fold. What reaches the driver is one row for each language and
    the model's entries."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], {}, np.zeros((1, 0)))
    share = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, rows_per_language / sizes[lang])))))
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    sample = labelled.where(chance < share[F.col("lang")]).select("text", "lang")
    counts = sample.mapInArrow(_counted, "lang string, key string, n long").groupBy("key", "lang").agg(F.sum("n").alias("n"))
    by_language = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    entries = counts.groupBy("key").agg(F.sum("n").alias("total"), by_language.alias("by"))
    each = F.array(*(F.coalesce(F.try_element_at("by", F.lit(lang)), F.lit(0)) for lang in languages)).alias("counts")
    is_gram = F.col("key").startswith("\x01")
    kept = pa.concat_tables([
        entries.where(~is_gram & (F.col("total") >= LEAST_COUNT)).orderBy(F.desc("total"), "key").limit(WORDS).select("key", each).toArrow(),
        entries.where(is_gram).orderBy(F.desc("total"), "key").limit(GRAMS).select("key", each).toArrow(),
    ]).combine_chunks()
    flat = kept.column("counts").combine_chunks().flatten() if len(kept) else pa.array([], pa.int64())
    return build(languages, kept.column("key").to_pylist(), flat.to_numpy(zero_copy_only=False).reshape(-1, len(languages)))


def build(languages: list[str], keys: list[str], counts: np.ndarray) -> Model:
    """Log frequencies within each kind of entry: words, and n-grams of each length. ``counts`` has a row for each key and
    a column for each language."""
    table = np.vstack([counts, np.zeros((1, len(languages)))]) + SMOOTHING
    kind = np.array([len(key) - 1 if key.startswith("\x01") else 0 for key in keys], np.int64)
    for k in range(LONGEST + 1):
        own = np.flatnonzero(kind == k)
        if len(own):
            table[own] = np.log(table[own] / table[own].sum(axis=0))
    table[-1] = table[:-1].min(initial=0)
    return Model(languages, {key: i for i, key in enumerate(keys)}, table)


class Scorer:
    """Words met before are remembered with their scores, up to a bound."""

    def __init__(self, model: Model, known: int = KNOWN) -> None:
        self.model, self.limit = model, known
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.empty((self.limit, len(self.model.languages)))

    def _cover(self, word: str) -> list[int]:
        """Rows of the model that stand for a word."""
        rows = self.model.rows
        if not word:
            return []
        if word in rows:
            return [rows[word]]
        padded, out = f" {word} ", []
        for i in range(len(padded) - 1):
            for n in range(LONGEST, 0, -1):
                row = rows.get("\x01" + padded[i : i + n])
                if row is not None:
                    out.append(row)
                    break
            else:
                out.append(len(self.model.weights) - 1)
        return out

    def _learn(self, words: list[str]) -> None:
        covers = [self._cover(_bare(w)) for w in words]
        sizes = np.fromiter(map(len, covers), np.int64, len(covers))
        flat = self.model.weights[np.array([r for c in covers for r in c], np.int64)]
        first = len(self.known)
        means = np.zeros((len(words), len(self.model.languages)))
        some = np.flatnonzero(sizes)
        if len(some):
            means[some] = np.add.reduceat(flat, (np.cumsum(sizes) - sizes)[some], axis=0) / sizes[some][:, None]
        self.scores[first : first + len(words)] = means
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.model.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        words = text.lower().split()
        total = np.zeros(len(self.model.languages))
        for i in range(0, len(words), self.limit):  # so that one text's words fit in the memory
            part = words[i : i + self.limit]
            new = list(set(part).difference(self.known))
            if len(self.known) + len(new) > self.limit:
                self.forget()
                new = list(set(part))
            if new:
                self._learn(new)
            total += self.scores[np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))].sum(axis=0)
        total = (total - total.max()) / math.sqrt(len(words))
        shares = np.exp(total) / np.exp(total).sum()
        best = int(shares.argmax())
        return self.model.languages[best], float(shares[best])


def language(model: Model, text: Column | str) -> Column:
    """struct<lang string, score double> of a text column. The model has a bounded number of entries and travels with
    the function."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @released
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            found = [scorer.predict(None if raw is None else raw.decode()) for raw in raw_texts(texts)]
            yield pa.array([{"lang": a, "score": b} for a, b in found], kind)

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "struct<lang string, score double>")(text)


def identify(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang; other columns are ignored).

    lang_pred is one of the labelled languages, or "und" with score 0 where the text is null or has no letter, or where
    there is no labelled document at all. Ties go to the language that sorts first. Rows repeated or without doc_id
    each give their row; without doc_id a row counts as held out.
    """
    found = docs.select("doc_id", language(fit(docs, rows_per_language), "text").alias("found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
