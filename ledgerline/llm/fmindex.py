"""A succinct FM-index over integer sequences (numpy, one shard in memory).

The Burrows-Wheeler transform of the shard is kept in a wavelet matrix: one
bit vector per bit of the alphabet, 64 positions to a word with a running
count per word, so a rank costs one popcount per level.  Suffixes are sorted
by their first ``DEPTH`` symbols, which makes the intervals of all patterns
up to that length exact.
"""

from __future__ import annotations

import numpy as np

DEPTH = 16


class WaveletMatrix:
    def __init__(self, values: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        n = len(values)
        for level in range(self.levels - 1, -1, -1):
            bit = ((values >> level) & 1).astype(np.uint8)
            padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            ones = np.bitwise_count(words).astype(np.int64)
            self.counts.append(np.concatenate(([0], np.cumsum(ones)[:-1])))
            self.zeros.append(int(n - bit.sum()))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of the sequence ends up among the symbol's
        own positions (plus a constant per symbol)."""
        for k in range(self.levels):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[k][word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = self.counts[k][word] + np.bitwise_count(below)
            right = (symbols >> (self.levels - 1 - k)) & 1 == 1
            at = np.where(right, self.zeros[k] + ones, at - ones)
        return at


def suffix_array(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (doubling)."""
    rank, length = text.astype(np.int64), 1
    while length < depth:
        shifted = np.zeros_like(rank)
        shifted[:-length] = rank[length:] + 1
        _, rank = np.unique(rank * (int(shifted.max()) + 1) + shifted, return_inverse=True)
        length *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """``text``: symbols 1..sigma with a 0 after every segment; ``label``: a number
    per position, of which ``least`` finds the minimum over an interval."""

    def __init__(self, text: np.ndarray, label: np.ndarray):
        order = suffix_array(text)
        sigma = int(text.max()) if len(text) else 0
        self.wavelet = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma + 1))))
        symbols = np.arange(sigma + 1)
        self.base = self.wavelet.descend(symbols, np.zeros(sigma + 1, dtype=np.int64))
        self.size = len(text)
        self.minima = [label[order]]
        step = 1
        while 2 * step <= self.size:
            low = self.minima[-1]
            self.minima.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol + pattern`` from those of ``pattern``."""
        at = self.first[symbols] - self.base[symbols]
        return at + self.wavelet.descend(symbols, lo), at + self.wavelet.descend(symbols, hi)

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics by backward search: for each end (exclusive) in
        ``text`` the length, up to ``most``, of the longest match that ends
        there, and its interval.  Symbol 0 matches nothing."""
        lo = np.zeros(len(ends), dtype=np.int64)
        hi = np.full(len(ends), self.size, dtype=np.int64)
        length = np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        for k in range(1, most + 1):
            at = ends[live] - k
            live, at = live[at >= 0], at[at >= 0]
            symbols = text[at]
            live, symbols = live[symbols > 0], symbols[symbols > 0]
            if not len(live):
                break
            new_lo, new_hi = self.extend(symbols, lo[live], hi[live])
            found = new_lo < new_hi
            live = live[found]
            lo[live], hi[live], length[live] = new_lo[found], new_hi[found], k
        return length, lo, hi

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest label in each non-empty interval."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=self.minima[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.minima[k][lo[at]], self.minima[k][hi[at] - (1 << int(k))])
        return out
