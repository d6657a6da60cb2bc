"""Token-id files with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id; each task encodes its range and streams the ids into one file in
the shared folder. A file holds the ids of its documents one after the other, two bytes each where the vocabulary
allows it, then two Elias-Fano codes: where each document ends, and the document ids themselves. Every attempt of a
task writes a file of its own name, and only the rows of successful tasks enter the stored manifest, so lost or
repeated attempts leave nothing but an unread file. The start of a file in the whole sequence is a running sum over
the manifest, one row per file.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tape_audit.llm.buffers import release, released
from tape_audit.llm.elias_fano import EliasFano
from tape_audit.llm.plain_words import PlainWords
from tape_audit.operators.staging import stage, staged_root

MAGIC = b"TOKENEF1"
END_ID = 1
KNOWN_WORDS = 400_000  # entries of a task's memory of encoded words; beyond it the older half is forgotten
#: A run of Latin letters that change case one by one, and the marks behind it.
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-įı-ɏ]{1,48}[!-/:-@\[-`{-~]*$"
PARTED = r"^(?P<body>[^!-/:-@\[-`{-~]*)(?P<marks>.*)$"
ENCODE_BYTES = 8_000_000  # of texts encoded at once, or one text
READ_IDS = 4_000_000  # ids read at once, or one document


class WordEncoder:
    """Ids of texts under a tokenizer that lower-cases and drops white space: it never joins characters over a blank or a
    line end, so a text's ids are those of its words in order. A batch of texts is split at once, each distinct word of it
    is encoded once, and the ids of all texts are gathered in one array. Words of Latin letters, marks behind them apart,
    go to the tokenizer's model and are remembered; others go through the library's whole way."""

    def __init__(self, path: str, known: int = KNOWN_WORDS) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(self.tokenizer)
        self.type = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.limit = known
        self.known: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> Iterator[bytes]:
        for got in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield array(self.type, got.ids).tobytes()

    def _bodies(self, words: list[str]) -> list[bytes]:
        known, tokens = self.known, self.plain.tokens
        for word in words:
            if word not in known:
                known[word] = array(self.type, [t.id for t in tokens(word)]).tobytes()
        out = [known[word] for word in words]
        if len(known) > self.limit:
            self.known = dict(islice(known.items(), len(known) // 2, None))
        return out

    def _flat(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // array(self.type).itemsize
        return np.frombuffer(b"".join(parts), self.type), sizes

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has: two parts of every word, the second may be empty."""
        plain = pc.match_substring_regex(words, PLAIN)
        parts = pc.extract_regex(pc.utf8_lower(words.filter(plain)), PARTED)
        body, tail = (parts.field(i).dictionary_encode() for i in (0, 1))
        odd = list(self._encode(words.filter(pc.invert(plain)).to_pylist()))
        known = [b"", *odd, *self._encode(tail.dictionary.to_pylist())]
        first, plain = len(known), plain.to_numpy(zero_copy_only=False)
        places = np.zeros((len(words), 2), np.int64)
        places[~plain, 0] = 1 + np.arange(len(odd))
        places[plain, 0], places[plain, 1] = first + body.indices.to_numpy(), 1 + len(odd) + tail.indices.to_numpy()
        ids, counts = gathered(*self._flat(known + self._bodies(body.dictionary.to_pylist())), places.ravel())
        return ids, counts.reshape(-1, 2).sum(axis=1)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other (a null has none), and how many each text has."""
        parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " "), " ")
        words = parts.flatten().dictionary_encode()
        ids, counts = gathered(*self._words(words.dictionary), words.indices.to_numpy())
        edges = np.concatenate(([0], np.cumsum(counts)))[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return ids, np.diff(edges)


def gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that ``codes`` name, one after the other, and their sizes; ``flat`` holds runs of ``sizes``."""
    counts = sizes[codes]
    shift = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(counts) - counts)
    return flat[np.arange(counts.sum()) + np.repeat(shift, counts)], counts


class TextEncoder(WordEncoder):
    """Ids under any tokenizer, whole text by whole text."""

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._flat(list(self._encode(pc.fill_null(texts, "").to_pylist())))


def encoder_of(tokenizer: str, by_word: bool) -> WordEncoder:
    return (WordEncoder if by_word else TextEncoder)(tokenizer)


def text_runs(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive slices of bounded size, or of one long text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENCODE_BYTES, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id behind each document's ids."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def _ascending(doc_ids: list[int | None]) -> tuple[int, int, np.ndarray]:
    """How many ids are null (they come first), the least id, and the others above it."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    return len(doc_ids) - len(known), base, known.view(np.uint64) - np.uint64(base & (1 << 64) - 1)


@released
def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, by_word: bool, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, lengths, doc_ids, sink = None, [], [], None
    for batch in batches:
        if encoder is None:
            encoder = encoder_of(tokenizer, by_word)
            width = array(encoder.type).itemsize
            store, root = fs.FileSystem.from_uri(folder)
            store.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.tok"
            sink = store.open_output_stream(f"{root}/{name}")
            sink.write(MAGIC)
        for texts in text_runs(batch.column("text")):
            ids, counts = with_end(*encoder.batch(texts), end_id)
            sink.write(ids.astype(f"<u{width}", copy=False).tobytes())
            lengths += counts.tolist()
            release()
        doc_ids += batch.column("doc_id").to_pylist()
    if sink is None:
        return
    nulls, base, above = _ascending(doc_ids)
    at, footer = len(MAGIC) + sum(lengths) * width, {"width": width, "nulls": nulls, "base": base}
    for key, code in (("ends", EliasFano.encode(np.cumsum(lengths))), ("docs", EliasFano.encode(above))):
        footer[key] = [code.count, code.width]
        for part in (code.high, code.low, code.samples):
            sink.write(part)
            footer[key] += [at, len(part)]
            at += len(part)
    text = json.dumps(footer).encode()
    sink.write(text + struct.pack("<I", len(text)) + MAGIC)
    sink.close()
    first = next((d for d in doc_ids if d is not None), None)
    yield pa.RecordBatch.from_pylist(
        [{"path": f"{folder}/{name}", "first_doc": first, "n_docs": len(lengths), "n_tokens": sum(lengths)}],
        pa.schema([("path", pa.string()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
    )


class TokenFile:
    """One file: random access to a document's ids by its place, or all documents in order."""

    def __init__(self, path: str) -> None:
        store, name = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(name)
        tail = self._read(self.file.size() - 4 - len(MAGIC), 4 + len(MAGIC))
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a finished token file")
        size = struct.unpack("<I", tail[:4])[0]
        footer = json.loads(self._read(self.file.size() - len(tail) - size, size))
        self.type = {2: "<u2", 4: "<u4"}[footer["width"]]
        self.width, self.nulls, self.base = footer["width"], footer["nulls"], footer["base"]
        self.ends, self.docs = (
            EliasFano(n, w, *(self._read(a, s) for a, s in zip(place[::2], place[1::2], strict=True)))
            for n, w, *place in (footer["ends"], footer["docs"])
        )

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _ids(self, first: int, last: int) -> np.ndarray:
        return np.frombuffer(self._read(len(MAGIC) + first * self.width, (last - first) * self.width), self.type)

    def tokens(self, i: int) -> np.ndarray:
        return self._ids(self.ends.get(i - 1) if i else 0, self.ends.get(i))

    def doc_ids(self) -> list[int | None]:
        return [*repeat(None, self.nulls), *(self.docs.all().view(np.uint64) + np.uint64(self.base & (1 << 64) - 1)).view(np.int64).tolist()]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of every document, reading a bounded run of ids at once."""
        ends, doc_ids, i = self.ends.all(), self.doc_ids(), 0
        while i < len(ends):
            start = int(ends[i - 1]) if i else 0
            upto = max(i + 1, int(np.searchsorted(ends, start + READ_IDS, "right")))
            ids = self._ids(start, int(ends[upto - 1]))
            for k in range(i, upto):
                first = int(ends[k - 1]) if k else 0
                yield doc_ids[k], first, ids[first - start : int(ends[k]) - start]
            i = upto


@released
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            rows = [(d, base + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in TokenFile(path).documents()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as readers outside Spark need it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, by_word: bool = False, end_id: int = END_ID) -> DataFrame:
    """Encodes ``docs`` (doc_id, text; other columns are ignored) into files below ``folder`` and returns the stored
    manifest (path, first_doc, n_docs, n_tokens, base), one row per file.

    Documents stand in ascending doc_id order, nulls first, rows of one doc_id by text; every row is written, and null
    and empty texts hold the end id alone. No documents, no files. ``by_word`` is for tokenizers that drop white space.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = stage(ordered.mapInArrow(lambda b: _write(b, folder, tokenizer, by_word, end_id), "path string, first_doc long, n_docs long, n_tokens long"), "token-files")
    order = Window.orderBy("first_doc").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of the manifest; a task for each file."""
    return manifest.select("path", "base").repartition(max(1, manifest.count()), "path").mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long",
    )


def token_digests(docs: DataFrame, tokenizer: str, by_word: bool = False, end_id: int = END_ID) -> DataFrame:
    """Writes the documents into the session's shared folder and reads them back."""
    folder = f"{staged_root(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_token_files(write_token_files(docs, folder, tokenizer, by_word, end_id))
