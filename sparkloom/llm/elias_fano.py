"""Elias-Fano coding of monotone sequences, with lookups for whole arrays of queries at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
ONE, LOW6 = U(1), U(63)


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """values of width bits each, side by side in 64-bit words (one spare word at the end)."""
    n = len(values)
    words = np.zeros(n * width // 64 + 2, U)
    if n and width:
        at = np.arange(n, dtype=U) * U(width)
        word, shift = (at >> U(6)).astype(np.int64), at & LOW6
        np.bitwise_or.at(words, word, values << shift)
        over = shift + U(width) > U(64)
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (U(64) - shift[over]))
    return words


def _select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th set bit (from 0) of each word."""
    at = np.zeros(len(word), np.int64)
    word, r = word.copy(), r.copy()
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & U((1 << width) - 1)).astype(np.int64)
        go = r >= below
        r -= below * go
        word >>= U(width) * go.astype(U)
        at += width * go
    return at


class EliasFano:
    """n values, none less than the one before. low: packed low bits; high: unary high bits, with counts before each word."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray, shape: np.ndarray):
        self.low, self.high, self.ones, self.zeros = low, high, ones, zeros
        self.n, self.width, self.top = int(shape[0]), int(shape[1]), int(shape[2])

    @classmethod
    def parts(cls, values: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays that make up the coding of sorted 64-bit values."""
        values = values.astype(U)
        n, last = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (last // n).bit_length() - 1) if n and last >= n else 0
        low = _pack_bits(values & U((1 << width) - 1), width)
        above = (values >> U(width)).astype(np.int64)
        top = last >> width
        bits = np.zeros((n + top + 1 + 63) // 64 + 1, U)
        at = above + np.arange(n)
        np.bitwise_or.at(bits, at >> 6, ONE << (at & 63).astype(U))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))[:-1]])
        zeros = np.arange(len(bits)) * 64 - ones
        kind = np.uint32 if max(int(ones[-1]), int(zeros[-1])) < 1 << 32 else np.int64
        return {"low": low, "high": bits, "ones": ones.astype(kind), "zeros": zeros.astype(kind), "shape": np.array([n, width, top], np.int64)}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), U)
        at = i.astype(U) * U(self.width)
        word, shift = (at >> U(6)).astype(np.int64), at & LOW6
        value = self.low[word] >> shift
        spill = self.low[word + 1] << ((U(64) - shift) & LOW6)
        value |= np.where(shift == 0, U(0), spill)
        return value & U((1 << self.width) - 1)

    def _select(self, counts: np.ndarray, i: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(counts, i.astype(counts.dtype), "right") - 1
        bits = self.high[word]
        return word * 64 + _select_in_word(~bits if flip else bits, i - counts[word].astype(np.int64))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i, all within [0, n)."""
        above = (self._select(self.ones, i, False) - i).astype(U)
        return above << U(self.width) | self._low(i)

    def successor(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element not less than each value (n if there is none), and whether it equals the value."""
        above = (value >> U(self.width)).astype(np.int64)
        beyond = above > self.top
        above = np.minimum(above, self.top)
        start = np.where(above > 0, self._select(self.zeros, np.maximum(above - 1, 0), True) - (above - 1), 0)
        stop = self._select(self.zeros, above, True) - above
        want = value & U((1 << self.width) - 1)
        low, high = start.copy(), stop.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            less = self._low(mid) < want[live]
            low[live] = np.where(less, mid + 1, low[live])
            high[live] = np.where(less, high[live], mid)
            live = live[low[live] < high[live]]
        equal = np.zeros(len(value), bool)
        inside = np.flatnonzero((low < stop) & ~beyond)
        equal[inside] = self._low(low[inside]) == want[inside]
        low[beyond] = self.n
        return low, equal
