"""Elias-Fano codes of ascending integers, with sampled select."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 256


def _pack(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


@dataclass
class EliasFano:
    """``count`` ascending values from 0: the low ``width`` bits of each stand side by side; the upper parts are the gaps
    of a bit string that holds a one for each value, so the i-th value is ``select(i) - i`` above its low bits. The
    place of every ``SAMPLE``-th one is kept, so that ``get`` scans a few bytes. About ``2 + width`` bits a value."""

    count: int
    width: int
    high: bytes
    low: bytes
    samples: bytes

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return EliasFano(n, width, np.packbits(bits, bitorder="little").tobytes(), _pack(values, width), ones[::SAMPLE].astype("<u4").tobytes())

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.count]
        low = np.zeros(self.count, np.int64)
        if self.width:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.count * self.width].reshape(-1, self.width)
            low = bits.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))
        return ((ones - np.arange(self.count)) << self.width) | low

    def get(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        bits = self.high[byte] >> (at % 8) << (at % 8)
        while (ones := bits.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            bits = self.high[byte]
        for _ in range(left):
            bits &= bits - 1
        place = byte * 8 + (bits & -bits).bit_length() - 1
        first, last = i * self.width // 8, ((i + 1) * self.width + 7) // 8
        low = int.from_bytes(self.low[first:last], "little") >> (i * self.width % 8) & ((1 << self.width) - 1)
        return (place - i) << self.width | low
