"""Token counts of the sections of a document, by offsets.

A document is encoded once as a whole. Every token has a span of characters in it, and so has every section; both run
from left to right without gaps, so joining the two is a merge of sorted positions. A token that crosses a boundary is
given to one section by an explicit rule: the section of its first character, of its last one, or the one that holds
most of it (the earlier one if equal).

The byte-level vocabulary splits a text into pieces (a run of letters, digits or marks with the blank before it, or
white space) before it merges anything, so pieces that were met before keep their tokens.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tape_audit.llm.buffers import raw_texts
from tape_audit.llm.plain_words import PlainWords

RULES = ("first", "last", "most")
KNOWN_PIECES = 200_000  # entries of a task's memory of encoded pieces; beyond it the memory starts anew
KNOWN_CHARS = 48
_PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_ODD_SPACE = re.compile(r"[\x1c-\x1f\u180e]")  # where notions of white space differ: such texts are encoded as a whole
RESULT = "struct<n_tokens bigint, n_sections bigint, crossing bigint, section_chars array<bigint>, section_tokens array<bigint>>"


def line_cuts(text: str) -> np.ndarray:
    """Where each line of a text begins, but for the first; the line end belongs to the line before."""
    return np.fromiter((m.end() for m in re.finditer("\n", text) if m.end() < len(text)), np.int64)


class SpanEncoder:
    def __init__(self, path: str, known: int = KNOWN_PIECES) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.plain = PlainWords(self.tokenizer)
        self.limit = known
        self.known: dict[str, bytes] = {}

    def _encode(self, pieces: list[str]) -> Iterator[bytes]:
        for got in self.tokenizer.encode_batch(pieces, add_special_tokens=False):
            yield array("I", chain.from_iterable(got.offsets)).tobytes()

    def _body(self, piece: str) -> bytes:
        """Spans of a plain word with the blank before it."""
        found = self.known.get(piece)
        if found is None:
            ends = list(accumulate(len(t.value) for t in self.plain.tokens(piece)))
            starts = [0, *ends[:-1]]
            if not piece.isascii():  # bytes to characters; a token may begin or end inside one
                at = [i for i, c in enumerate(piece) for _ in c.encode()]
                starts, ends = [at[s] for s in starts], [at[e - 1] + 1 for e in ends]
            found = self.known[piece] = array("I", chain.from_iterable(zip(starts, ends, strict=True))).tobytes()
        return found

    def _marks(self, run: str) -> array:
        if run not in self.known:
            self.known[run] = next(self._encode([run]))
        return array("I", self.known[run])

    def _learn(self, pieces: set[str]) -> None:
        odd = []
        for piece in pieces:
            blank = piece[0] == " "
            parted = self.plain.parted(piece[blank:])
            if parted is None:
                odd.append(piece)
            elif parted[1]:
                first = len(piece) - len(parted[1])
                self.known[piece] = self._body(piece[:first]) + array("I", (i + first for i in self._marks(parted[1]))).tobytes()
            else:
                self._body(piece)
        if odd:
            self.known.update(zip(odd, self._encode(odd), strict=True))

    def spans(self, text: str) -> np.ndarray:
        """(first, end) in characters of every token. Tokens that share a character share its place."""
        if _ODD_SPACE.search(text):
            return np.frombuffer(next(self._encode([text])), np.uint32).reshape(-1, 2).astype(np.int64)
        pieces = _PIECE.findall(text)
        new = set(pieces).difference(self.known)
        if new:
            self._learn(new)
        own = list(map(self.known.__getitem__, pieces))
        if len(self.known) > self.limit:
            self.known = {}
        elif new:
            for piece in [p for p in new if len(p) > KNOWN_CHARS]:
                self.known.pop(piece, None)
                self.known.pop(piece[:-1], None)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = np.fromiter(map(len, own), np.int64, len(own)) // 8
        spans = np.frombuffer(b"".join(own), np.uint32).reshape(-1, 2).astype(np.int64)
        return spans + np.repeat(np.cumsum(lengths) - lengths, counts)[:, None]


def owners(spans: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """The section of every token, and how many tokens cross a boundary. Section i ends where cut i stands."""
    first = np.searchsorted(cuts, spans[:, 0], "right")
    last = np.searchsorted(cuts, np.maximum(spans[:, 0], spans[:, 1] - 1), "right")
    crossing = int((first != last).sum())
    if rule == "first" or not crossing:
        return first, crossing
    if rule == "last":
        return last, crossing
    for i in np.flatnonzero(first != last):
        edges = np.concatenate([spans[i, :1], cuts[first[i] : last[i]], spans[i, 1:]])
        first[i] += int(np.argmax(np.diff(edges)))
    return first, crossing


def attribute(text: Column | str, tokenizer: str, rule: str = "first", cuts: Callable[[str], np.ndarray] = line_cuts) -> Column:
    """struct ``RESULT`` of a text column: tokens of the whole text and of each of its sections, in their order. ``cuts``
    gives the ascending places inside a text where a section begins. Null and empty texts have no sections."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    kind = pa.struct([(n, pa.int64()) for n in ("n_tokens", "n_sections", "crossing")] + [(n, pa.list_(pa.int64())) for n in ("section_chars", "section_tokens")])

    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = SpanEncoder(tokenizer)
        for texts in batches:
            rows = []
            for raw in raw_texts(texts):
                row = {"n_tokens": 0, "n_sections": 0, "crossing": 0, "section_chars": [], "section_tokens": []}
                if raw:
                    whole = raw.decode()
                    spans, at = encoder.spans(whole), cuts(whole)
                    own, crossing = owners(spans, at, rule)
                    row = {
                        "n_tokens": len(spans), "n_sections": len(at) + 1, "crossing": crossing,
                        "section_chars": np.diff(np.concatenate([[0], at, [len(whole)]])),
                        "section_tokens": np.bincount(own, minlength=len(at) + 1),
                    }
                rows.append(row)
            yield pa.array(rows, kind)

    counted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(counted, RESULT)(text)


def section_tokens(docs: DataFrame, tokenizer: str, rule: str = "first", cuts: Callable[[str], np.ndarray] = line_cuts) -> DataFrame:
    """(doc_id, n_tokens, n_sections, crossing, section_chars, section_tokens) for every row of ``docs`` (doc_id, text;
    other columns are ignored). The sections' tokens sum to the document's. Rows repeated or without doc_id each give
    their row; a text may be of any length."""
    return docs.select("doc_id", attribute("text", tokenizer, rule, cuts).alias("t")).select("doc_id", "t.*")
