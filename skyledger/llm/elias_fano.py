"""Monotone sequences of integers in Elias-Fano coding, searched by numpy on memory-mapped bytes.

Each value is split: its low bits lie packed side by side, its high bits are a unary bit vector (for each
value of the high part, ones for its members, then a zero). With n values below u this takes about
2 + log2(u / n) bits a value. A count of zeros per 64-bit word makes selection a binary search.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BYTE_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)


def _select_table() -> np.ndarray:
    """Place of the k-th set bit of a byte, low bits first."""
    table = np.full((256, 8), 8, np.int64)
    for value in range(256):
        places = [bit for bit in range(8) if value >> bit & 1]
        table[value, : len(places)] = places
    return table


_SELECT = _select_table()


class EliasFano:
    """``values`` are non-decreasing and below 2^62."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros
        #: Ones before each word; the same directory read the other way.
        self.ones = (np.arange(len(high), dtype=np.int64) * 64) - zeros

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, _U)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, int(np.floor(np.log2((top + 1) / n)))) if n else 0
        # Low bits: a matrix of bits, packed; in blocks, so that the matrix stays small.
        packed = []
        if low_bits:
            step = 1 << 17  # a multiple of 64 values ends on a whole word
            shifts = np.arange(low_bits, dtype=_U)
            for first in range(0, n, step):
                bits = (values[first : first + step, None] >> shifts) & _U(1)
                packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
        low_bytes = np.concatenate(packed) if packed else np.empty(0, np.uint8)
        low = np.zeros((len(low_bytes) + 7) // 8 + 2, _U)
        low.view(np.uint8)[: len(low_bytes)] = low_bytes
        high_values = (values >> _U(low_bits)).astype(np.int64)
        length = n + (int(high_values[-1]) if n else 0) + 2
        words = np.zeros((length + 63) // 64, _U)
        places = high_values + np.arange(n)
        np.bitwise_or.at(words, places >> 6, _U(1) << (places & 63).astype(_U))
        ones = np.bitwise_count(words).astype(np.int64)
        zeros = (np.cumsum(64 - ones) - (64 - ones)).astype(np.int64)
        return cls(n, low_bits, low, words, zeros)

    def dump(self) -> list[bytes]:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.int64)
        return [head.tobytes(), self.low.tobytes(), self.high.tobytes(), self.zeros.tobytes()]

    @classmethod
    def load(cls, data: memoryview, at: int) -> tuple["EliasFano", int]:
        n, low_bits, n_low, n_high = np.frombuffer(data, np.int64, 4, at).tolist()
        at += 32
        low = np.frombuffer(data, _U, n_low, at)
        high = np.frombuffer(data, _U, n_high, at + 8 * n_low)
        zeros = np.frombuffer(data, np.int64, n_high, at + 8 * (n_low + n_high))
        return cls(n, low_bits, low, high, zeros), at + 8 * (n_low + 2 * n_high)

    def _select(self, counts: np.ndarray, k: np.ndarray, invert: bool) -> np.ndarray:
        """Places of the k-th (from 0) bit that is one, or zero if ``invert``."""
        word = np.searchsorted(counts, k, side="right") - 1
        rest = k - counts[word]
        bits = ~self.high[word] if invert else self.high[word]
        place = word * 64
        out = np.full(len(k), -1, np.int64)
        for byte in range(8):
            value = ((bits >> _U(8 * byte)) & _U(255)).astype(np.int64)
            held = _BYTE_ONES[value]
            here = (out < 0) & (rest < held)
            out[here] = place[here] + 8 * byte + _SELECT[value[here], rest[here]]
            rest = np.where(out < 0, rest - held, rest)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        at = i.astype(np.int64) * self.low_bits
        word, shift = at >> 6, (at & 63).astype(_U)
        value = self.low[word] >> shift
        over = shift + _U(self.low_bits) > _U(64)
        value |= np.where(over, self.low[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
        return value & _U((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = self._select(self.ones, i, False) - i
        return (high.astype(_U) << _U(self.low_bits)) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Index of the first element that is at least the value; n if there is none."""
        return self.find(values)[0]

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The successor's index, and whether it equals the value."""
        values = np.asarray(values, _U)
        if not self.n:
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        high = (values >> _U(self.low_bits)).astype(np.int64)
        last = self.high_top()
        beyond = high > last
        high = np.minimum(high, last)
        start = np.zeros(len(values), np.int64)
        later = high > 0
        start[later] = self._select(self.zeros, high[later] - 1, True) - (high[later] - 1)
        end = self._select(self.zeros, high, True) - high
        want = values & _U((1 << self.low_bits) - 1)
        low, up = start.copy(), end.copy()
        while (open_ := low < up).any():
            middle = (low + up) >> 1
            less = open_ & (self._low(middle) < want)
            low = np.where(less, middle + 1, low)
            up = np.where(open_ & ~less, middle, up)
        equal = (low < end) & ~beyond
        equal[equal] = self._low(low[equal]) == want[equal]
        return np.where(beyond, self.n, low), equal

    def high_top(self) -> int:
        """The high part of the last element."""
        return int(self._select(self.ones, np.array([self.n - 1]), False)[0]) - (self.n - 1)
