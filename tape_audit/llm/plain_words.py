"""Tokens of plain words straight from a byte-level BPE model.

The model of a tokenizer file works on one pre-token at a time, written with one character for each byte. For a run of
Latin letters the normaliser and the pre-tokenizer have nothing to decide but case, so such a word can go to the model
directly; anything else takes the library's whole way.
"""

from __future__ import annotations

import string

from tokenizers import Tokenizer

LATIN_END = "ɐ"  # letters below it are composed already and change case one by one
MARKS = string.punctuation


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PlainWords:
    def __init__(self, tokenizer: Tokenizer) -> None:
        self.model = tokenizer.model
        letters = byte_letters()
        latin = range(128, ord(LATIN_END))
        lower = {ord(x) for c in latin for x in chr(c).lower()}  # of some letters it lies beyond
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in {32, *latin, *lower}}

    @staticmethod
    def is_plain(word: str) -> bool:
        return word.isalpha() and (word.isascii() or max(word) < LATIN_END)

    def parted(self, word: str) -> tuple[str, str] | None:
        """A plain word and the run of marks behind it, which is a pre-token of its own; None if it is anything else."""
        body = word.rstrip(MARKS)
        return (body, word[len(body) :]) if self.is_plain(body) else None

    def tokens(self, word: str) -> list:
        """Tokens of a plain word, which a blank may precede; their values have a character for each byte."""
        if word.isascii():
            return self.model.tokenize(word if word[0] != " " else self.letters[32] + word[1:])
        return self.model.tokenize(word.translate(self.letters))
