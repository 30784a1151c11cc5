"""An FM-index over integer symbols: the Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np


class _Bits:
    """A packed bit vector with ranks: one running total per 64 bits."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:], dtype=np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)


class FMIndex:
    """Backward search of patterns of up to ``depth`` symbols in ``symbols``, whose 0 separates texts and is never searched for.

    Suffixes are sorted by their first ``depth`` symbols at least, which is all that ranges of shorter patterns depend on.
    """

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        symbols = np.append(np.asarray(symbols, np.int64), 0)
        self.size, top = len(symbols), int(symbols.max()) + 1
        rank, known = symbols, 1
        order = np.argsort(rank, kind="stable")
        while known < depth:
            after = np.zeros(self.size, np.int64)
            after[: max(0, self.size - known)] = rank[known:] + 1
            key = rank * (self.size + top + 1) + after
            order = np.argsort(key, kind="stable")
            rank = np.zeros(self.size, np.int64)
            rank[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
            known *= 2
            if rank[order[-1]] == self.size - 1:
                break
        self.order = order
        bwt = symbols[order - 1]
        self.smaller = np.zeros(top + 1, np.int64)
        self.smaller[1:] = np.cumsum(np.bincount(symbols, minlength=top))
        self.levels: list[tuple[int, _Bits, int]] = []
        for shift in reversed(range(max(1, (top - 1).bit_length()))):
            bit = (bwt >> shift) & 1
            self.levels.append((shift, _Bits(bit.astype(bool)), int(self.size - bit.sum())))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        self.base = np.zeros(top, np.int64)
        self.base = self._descend(np.arange(top), np.zeros(top, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that start with ``symbol`` and go on as those between ``low`` and ``high``."""
        first, base = self.smaller[symbol], self.base[symbol]
        return first + self._descend(symbol, low) - base, first + self._descend(symbol, high) - base


def matching_lengths(index: FMIndex, text: np.ndarray, ends: np.ndarray, limit: int, heavy: np.ndarray) -> np.ndarray:
    """For each position in ``ends`` the length, up to ``limit``, of the longest run of ``text`` that ends there and is found at
    two or more places of the index. ``heavy`` marks the places (positions of the indexed text) that count twice."""
    total = np.zeros(index.size + 1, np.int64)
    marked = np.append(np.asarray(heavy, bool), False)
    total[1:] = np.cumsum(marked[index.order])
    length = np.zeros(len(ends), np.int64)
    active = np.arange(len(ends))
    low, high = np.zeros(len(ends), np.int64), np.full(len(ends), index.size, np.int64)
    for step in range(limit):
        at = ends[active] - step
        symbol = np.where(at >= 0, text[np.maximum(at, 0)], 0)
        known = symbol > 0
        active, symbol, low, high = active[known], symbol[known], low[known], high[known]
        low, high = index.extend(symbol, low, high)
        again = (high - low >= 2) | ((high > low) & (total[high] > total[low]))
        active, low, high = active[again], low[again], high[again]
        length[active] = step + 1
        if not len(active):
            break
    return length
