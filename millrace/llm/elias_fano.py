"""Elias-Fano sequences of sorted numbers in flat bytes, searched many numbers at a time.

A number is split into its low bits, packed one after the other, and its high part: bit
``high + index`` of a bit vector is set for each number, so the vector's zeros end the
buckets of equal high parts.  The zeros and ones before each block of 512 bits are kept
beside it.  A search decodes only the blocks and low bits that it needs.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512


class EliasFano:
    """A sequence over arrays that may be memory-mapped."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros

    @classmethod
    def encode(cls, numbers: np.ndarray, limit: int) -> EliasFano:
        """From ascending unsigned numbers below ``limit``."""
        numbers = numbers.astype(np.uint64)
        n = len(numbers)
        low_bits = max(0, (limit // max(1, n)).bit_length() - 1)
        packed = []
        places = np.arange(low_bits, dtype=np.uint64)
        for at in range(0, n, 1 << 16):  # eight numbers' bits fill whole bytes
            some = numbers[at : at + (1 << 16)]
            bits = (some[:, None] >> places & np.uint64(1)).astype(np.uint8)
            packed.append(np.packbits(bits.ravel(), bitorder="little"))
        low = np.concatenate([*packed, np.zeros(9, np.uint8)])
        tops = (numbers >> np.uint64(low_bits)).astype(np.int64)
        size = n + ((limit - 1) >> low_bits) + 1 if limit else 1
        bits = np.zeros(-(-(size + 1) // BLOCK) * BLOCK, np.uint8)
        bits[tops + np.arange(n)] = 1
        filled = bits.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(BLOCK - filled)]).astype(np.int64)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), zeros)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.zeros]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        n, low_bits = arrays[0].tolist()
        return cls(n, low_bits, *arrays[1:])

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        at = index * self.low_bits
        byte, shift = at >> 3, (at & 7).astype(np.uint64)
        # Eight bytes from any byte on, as one number.
        words = np.ndarray((len(self.low) - 7,), "<u8", self.low, 0, (1,))
        value = words[byte] >> shift
        if self.low_bits > 57:
            spill = np.flatnonzero((at & 7) + self.low_bits > 64)
            more = self.low[byte[spill] + 8].astype(np.uint64)
            value[spill] |= more << (np.uint64(64) - shift[spill])
        return value & np.uint64((1 << self.low_bits) - 1)

    def _select(self, nth: np.ndarray, bit: int) -> np.ndarray:
        """Places of the nth (from 0) zeros or ones of the high bits; nth ascends."""
        before = self.zeros if bit == 0 else np.arange(len(self.zeros)) * BLOCK - self.zeros
        block = np.searchsorted(before, nth, "right") - 1
        fresh = np.diff(block, prepend=-1) != 0
        needed, which = block[fresh], np.cumsum(fresh) - 1
        data = self.high.reshape(-1, BLOCK // 8)[needed]
        bits = np.unpackbits(data.ravel(), bitorder="little")
        places = np.flatnonzero(bits == bit)
        held = before[needed + 1] - before[needed]
        start = np.cumsum(held) - held
        place = places[start[which] + nth - before[block]]
        return place - which * BLOCK + block * BLOCK

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """The index of each of the ascending numbers, or -1 where it isn't one of them.

        The search goes to the least number not below the one looked for.
        """
        numbers = numbers.astype(np.uint64)
        tops = (numbers >> np.uint64(self.low_bits)).astype(np.int64)
        index = np.full(len(numbers), -1, np.int64)
        asked = np.flatnonzero(tops < self.zeros[-1])
        if not self.n or not len(asked):
            return index
        tops = tops[asked]
        stop = self._select(tops, 0) - tops
        first = np.maximum(tops - 1, 0)
        start = np.where(tops > 0, self._select(first, 0) - first, 0)
        wanted = numbers[asked] & np.uint64((1 << self.low_bits) - 1)
        low, high = start.copy(), np.minimum(stop, self.n)
        end = high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self._lows(middle) < wanted[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        inside = np.flatnonzero(low < end)
        same = self._lows(low[inside]) == wanted[inside]
        index[asked[inside[same]]] = low[inside[same]]
        return index

    def at(self, index: np.ndarray) -> np.ndarray:
        """The numbers at ascending indexes."""
        if not len(index):
            return np.zeros(0, np.uint64)
        tops = self._select(index, 1) - index
        return tops.astype(np.uint64) << np.uint64(self.low_bits) | self._lows(index)
