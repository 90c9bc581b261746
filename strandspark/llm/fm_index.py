"""A compressed FM-index over word sequences: Burrows-Wheeler transform in a wavelet matrix.

Sequences are indexed together, each closed by a separator of its own. All queries step at once:
one backward step for all of them is two rank queries on every level of the matrix. The index also
knows which neighbouring suffixes agree in their first `length` words, so an interval of a longer match can
be widened to the interval of its first `length` words (matching statistics above the threshold).
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """rank of a symbol before a place, over packed bits with a count per 64 of them."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        at = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (at >> level & 1).astype(bool)
            packed = np.zeros((len(at) // 64 + 1) * 8, np.uint8)
            some = np.packbits(bit, bitorder="little")
            packed[: len(some)] = some
            words = packed.view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))])
            self.zeros.append(len(at) - int(bit.sum()))
            at = np.concatenate([at[~bit], at[bit]])
        self.begin = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            block = places >> 6
            ones = self.counts[k][block] + np.bitwise_count(self.bits[k][block] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)))
            places = np.where(symbols >> level & 1 == 1, self.zeros[k] + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._down(symbols, places) - self.begin[symbols]


class FMIndex:
    def __init__(self, symbols: np.ndarray, first: np.ndarray, length: int) -> None:
        """symbols: words of all sequences as numbers from 0 on; first: where each begins."""
        n_seq, sizes = len(first) - 1, np.diff(first)
        n = len(symbols) + n_seq
        place = np.arange(len(symbols)) + np.repeat(np.arange(n_seq), sizes)  # a separator after each
        text = np.zeros(n, np.int64)
        text[place] = symbols + 1
        ends = first[1:] + np.arange(n_seq)
        rank = text + n_seq - 1
        rank[ends] = np.arange(n_seq)
        half, width, at_half = 1 << (length.bit_length() - 1), 1, None
        while True:
            if width == half:
                at_half = rank
            if width > length and rank.max() == n - 1:
                break
            beyond = np.zeros(n, np.int64)
            beyond[: n - width] = rank[width:] + 1
            rank = np.unique(rank * (n + 1) + beyond, return_inverse=True)[1]
            width *= 2
        suffixes = np.empty(n, np.int64)
        suffixes[rank] = np.arange(n)
        self.of_suffix = np.searchsorted(ends, suffixes)  # the sequence each suffix begins in
        left = ends[self.of_suffix] - suffixes
        again = np.minimum(suffixes + length - half, n - 1)
        same = (at_half[suffixes[1:]] == at_half[suffixes[:-1]]) & (at_half[again[1:]] == at_half[again[:-1]]) & (left[1:] >= length) & (left[:-1] >= length)
        self.group = np.r_[0, np.cumsum(~same)]
        self.group_first = np.flatnonzero(np.r_[True, ~same])
        self.bwt = WaveletMatrix(text[suffixes - 1], int(text.max()) + 1)
        self.less = np.searchsorted(np.sort(text), np.arange(int(text.max()) + 1))
        self.n = n

    def step(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one more word in front."""
        symbols = symbols + 1
        both = self.bwt.rank(np.r_[symbols, symbols], np.r_[lo, hi])
        return self.less[symbols] + both[: len(lo)], self.less[symbols] + both[len(lo) :]

    def least_of_groups(self, values: np.ndarray) -> np.ndarray:
        """For each group of suffixes that agree in `length` words, the least value of their sequences."""
        return np.minimum.reduceat(values[self.of_suffix], self.group_first)
