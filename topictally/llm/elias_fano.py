"""Monotone sequences in Elias-Fano code, with vectorised access and successor search.

A sequence of n numbers below u takes about 2 + log2(u / n) bits each: the lower bits as they are,
the upper bits in unary. All parts are flat little-endian arrays that can be mapped into memory and
are read in place.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np

#: For each byte, the places of its zeros, lowest first, filled up with 8.
ZEROS = np.full((256, 8), 8, dtype=np.uint8)
for _byte in range(256):
    _places = [i for i in range(8) if not _byte >> i & 1]
    ZEROS[_byte, : len(_places)] = _places
ZERO_COUNT = (ZEROS < 8).sum(axis=1).astype(np.int64)
ONES = np.full((256, 8), 8, dtype=np.uint8)
for _byte in range(256):
    _places = [i for i in range(8) if _byte >> i & 1]
    ONES[_byte, : len(_places)] = _places


def mapped(body: bytes) -> mmap.mmap | bytes:
    """The bytes in a memory map of their own, which holds no file."""
    if not body:
        return body
    place = mmap.mmap(-1, len(body))
    place.write(body)
    return place


class EliasFano:
    """``encode`` gives the bytes of a sequence; an instance reads them."""

    HEADER = "<QQQ"

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> bytes:
        """Bytes of sorted numbers from 0 to ``universe`` inclusive."""
        values = values.astype(np.uint64)
        n = len(values)
        low = min(63, max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1))
        upper = (values >> np.uint64(low)).astype(np.int64)
        size = n + (universe >> low) + 1
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[upper + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little")
        lower = np.zeros(0, dtype=np.uint8)
        if low:
            steps = np.arange(low, dtype=np.uint64)
            runs = (values[i : i + 8192, None] for i in range(0, n, 8192))
            bits = [((run >> steps) & np.uint64(1)).astype(np.uint8).ravel() for run in runs]
            lower = np.concatenate([np.packbits(b, bitorder="little") for b in bits] or [lower])
        # Eight more bytes, so that a number can be read in one piece at the end.
        tail = bytes(9)
        return struct.pack(cls.HEADER, n, low, len(high)) + high.tobytes() + lower.tobytes() + tail

    def __init__(self, body: mmap.mmap | bytes):
        self.n, self.low, size = struct.unpack_from(self.HEADER, body)
        at = struct.calcsize(self.HEADER)
        self.high = np.frombuffer(body, np.uint8, size, at)
        self.lower = np.frombuffer(body, np.uint8, -1, at + size)
        counts = ZERO_COUNT[self.high]
        # Zeros and ones before each run of 8 bytes: a directory of an eighth of the bits.
        zeros = np.cumsum(counts.reshape(-1, 8).sum(axis=1))
        self.zeros = np.concatenate([[0], zeros])
        self.ones = np.arange(len(self.zeros)) * 64 - self.zeros

    def _select(self, rank: np.ndarray, before: np.ndarray, table: np.ndarray, of_ones: bool):
        """Place of the zero or one with this rank, counted from 0."""
        word = np.searchsorted(before, rank, "right") - 1
        left = rank - before[word]
        place = word * 8
        todo = np.arange(len(rank))
        for _ in range(8):
            body = self.high[place[todo]]
            count = ZERO_COUNT[body]
            if of_ones:
                count = 8 - count
            beyond = left[todo] >= count
            todo, count = todo[beyond], count[beyond]
            if not len(todo):
                break
            left[todo] -= count
            place[todo] += 1
        return place * 8 + table[self.high[place], left]

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), dtype=np.uint64)
        bit = at * self.low
        byte = (bit >> 3)[:, None] + np.arange(9)
        parts = self.lower[byte].astype(np.uint64)
        shift = (bit & 7).astype(np.uint64)
        value = (parts[:, :8] << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        value >>= shift
        more = np.where(shift > 0, parts[:, 8] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), 0)
        value |= more.astype(np.uint64)
        return value & self._mask()

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        at = np.asarray(at, dtype=np.int64)
        upper = self._select(at, self.ones, ONES, True) - at
        return (upper.astype(np.uint64) << np.uint64(self.low)) | self._low(at)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the first element not below each value; place n beyond the last."""
        left, _ = self._place(values)
        found = np.zeros(len(left), dtype=np.uint64)
        inside = left < self.n
        found[inside] = self.get(left[inside])
        return left, found

    def index(self, values: np.ndarray) -> np.ndarray:
        """Place of the first element equal to each value, -1 where there is none."""
        left, end = self._place(values)
        at = np.flatnonzero(left < end)
        same = self._low(left[at]) == (np.asarray(values, dtype=np.uint64)[at] & self._mask())
        found = np.full(len(left), -1, dtype=np.int64)
        found[at[same]] = left[at[same]]
        return found

    def _mask(self) -> np.uint64:
        return np.uint64((1 << self.low) - 1)

    def _place(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element not below each value, and the end of its upper bits' run."""
        values = np.asarray(values, dtype=np.uint64)
        upper = (values >> np.uint64(self.low)).astype(np.int64)
        zeros = int(self.zeros[-1])
        beyond = upper >= zeros
        safe = np.where(beyond, 0, upper)
        begin = np.where(safe > 0, self._select(np.maximum(safe - 1, 0), self.zeros, ZEROS, False) - safe + 1, 0)
        end = self._select(safe, self.zeros, ZEROS, False) - safe
        begin = np.where(beyond, self.n, np.minimum(begin, self.n))
        end = np.where(beyond, self.n, np.minimum(end, self.n))
        # Elements from begin to end share the upper bits; halve until the lower bits are found.
        wanted = values & self._mask()
        left, right = begin.copy(), end.copy()
        todo = np.flatnonzero(left < right)
        while len(todo):
            middle = (left[todo] + right[todo]) >> 1
            below = self._low(middle) < wanted[todo]
            left[todo] = np.where(below, middle + 1, left[todo])
            right[todo] = np.where(below, right[todo], middle)
            todo = todo[left[todo] < right[todo]]
        return left, end
