"""A compressed full-text index over word numbers: wavelet matrix of the Burrows-Wheeler transform.

All functions work on whole arrays of patterns at once; an index covers one bounded shard.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` symbols at least, by doubling the compared length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        # Rank and the rank behind it as one number: both are below n + 1.
        pair = rank * (n + 1)
        pair[: n - length] += rank[length:] + 1
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        length *= 2
        if rank[order[-1]] == n - 1 or length >= min(depth, n):
            return order


class BitVector:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1]))

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """One bit vector per binary digit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[int, BitVector, int]] = []
        for digit in reversed(range(max(int(symbols.max(initial=0)), 1).bit_length())):
            bits = ((symbols >> digit) & 1).astype(np.uint8)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((digit, BitVector(bits), zeros))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``at`` positions."""
        start = np.zeros_like(at)
        for digit, bits, zeros in self.levels:
            one = ((symbol >> digit) & 1).astype(bool)
            low, high = bits.rank1(start), bits.rank1(at)
            start = np.where(one, zeros + low, start - low)
            at = np.where(one, zeros + high, at - high)
        return at - start


class FMIndex:
    """Backward search for up to ``depth`` word numbers; 0 ends the text and must not occur in it.

    The text is not kept, nor are the places of its suffixes: an index is the wavelet matrix of its
    transform, and of each suffix the document that holds it.
    """

    def __init__(self, text: np.ndarray, depth: int, holders: np.ndarray):
        text = np.concatenate((text, [0])).astype(np.int64)
        order = suffix_order(text, depth)
        self.bwt = WaveletMatrix(text[order - 1])
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.size = len(text)
        self.holders = np.append(holders, np.iinfo(np.int64).max)[order]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row of ``patterns``: matched length from its end, and the suffix interval of that match.

        A pattern is followed while its interval holds more than one suffix: that is the statistic of
        interest, as a single suffix is the place the pattern was taken from.
        """
        n, width = patterns.shape
        low = np.zeros(n, np.int64)
        high = np.full(n, self.size, np.int64)
        matched = np.zeros(n, np.int64)
        active = np.arange(n)
        for column in range(width - 1, -1, -1):
            symbol = patterns[active, column]
            start = self.first[symbol] + self.bwt.rank(symbol, low[active])
            stop = self.first[symbol] + self.bwt.rank(symbol, high[active])
            shared = stop - start > 1
            active = active[shared]
            low[active], high[active] = start[shared], stop[shared]
            matched[active] += 1
            if not len(active):
                break
        return matched, low, high

    def least_holder(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest document of each suffix interval."""
        ends = np.append(self.holders, np.iinfo(np.int64).max)
        return np.minimum.reduceat(ends, np.stack((low, high), axis=1).reshape(-1))[::2]
