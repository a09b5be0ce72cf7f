"""A compressed FM-index over word codes: a wavelet matrix of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector in 64-bit words with the ones before each word; counts ones before a position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Occurrences of a code before a position, one bit vector per bit of the codes."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.levels: list[tuple[int, RankBits, int]] = []
        for bit in reversed(range(bits)):
            ones = (codes >> bit & 1).astype(bool)
            vector = RankBits(ones.astype(np.uint8))
            self.levels.append((bit, vector, int(len(codes) - ones.sum())))
            codes = np.r_[codes[~ones], codes[ones]]

    def narrow(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query, where the code's occurrences among positions ``low..high`` lie, level by level."""
        for bit, vector, zeros in self.levels:
            one = (codes >> bit & 1).astype(bool)
            ones_low, ones_high = vector.rank(low), vector.rank(high)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return low, high


class FMIndex:
    """Backward search for patterns of up to ``reach`` codes.

    Suffixes are sorted by their first ``reach`` codes (rounded up to a power of two), which is all a
    backward search for such patterns compares. Code 0 separates texts; patterns do not hold it.
    """

    def __init__(self, text: np.ndarray, reach: int):
        self.bits = max(1, int(text.max(initial=0)).bit_length())
        self.suffixes = bounded_suffix_array(text, reach)
        transform = text[self.suffixes - 1]
        self.tree = WaveletMatrix(transform, self.bits)
        # Where each code's occurrences start at the tree's bottom is constant per code, and so is the
        # start of its suffixes: the difference maps one to the other.
        counts = np.bincount(text, minlength=1 << self.bits)
        starts = np.cumsum(counts) - counts
        every = np.arange(1 << self.bits)
        bottom, _ = self.tree.narrow(every, np.zeros(len(every), np.int64), np.zeros(len(every), np.int64))
        self.shift = starts - bottom
        self.size = len(text)

    def extend_left(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of ``code + pattern`` from those of ``pattern``."""
        low, high = self.tree.narrow(codes, low, high)
        return low + self.shift[codes], high + self.shift[codes]

    def matching(self, text: np.ndarray, ends: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of ``text`` at ``ends`` (exclusive), up to ``reach``.

        Returns for each end the longest match of the text before it, and that match's suffix range.
        """
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        length = np.zeros(len(ends), np.int64)
        open_ = np.arange(len(ends))
        for step in range(1, reach + 1):
            at = ends[open_] - step
            open_, at = open_[at >= 0], at[at >= 0]
            codes = text[at]
            open_, codes = open_[codes > 0], codes[codes > 0]
            if not len(open_):
                break
            a, b = self.extend_left(codes, low[open_], high[open_])
            found = a < b
            open_ = open_[found]
            low[open_], high[open_], length[open_] = a[found], b[found], step
        return length, low, high


def bounded_suffix_array(text: np.ndarray, reach: int) -> np.ndarray:
    """Suffix starts sorted by their first ``reach`` codes at least, by prefix doubling."""
    rank = text.astype(np.int64)
    width = 1
    order = np.argsort(rank, kind="stable")
    while width < reach:
        following = np.zeros(len(rank), np.int64)
        following[: len(rank) - width] = rank[width:] + 1
        key = rank * (int(following.max(initial=0)) + 1) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        rank = np.empty_like(rank)
        rank[order] = new
        width *= 2
        if len(new) and new[-1] == len(new) - 1:
            break
    return order
