"""A compressed FM-index over word numbers in numpy, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with one running count per 64 of them."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        padded = np.zeros((self.size // 64 + 1) * 64, np.uint8)
        padded[: self.size] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The number of ones in front of each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletTree:
    """A wavelet tree laid out by levels: how often a symbol occurs in front of a place."""

    def __init__(self, symbols: np.ndarray, symbol_count: int):
        self.bits = max(1, int(symbol_count - 1).bit_length())
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(self.bits - 1, -1, -1):
            ones = (symbols >> shift) & 1
            self.levels.append((shift, BitVector(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        # On the lowest level all places of a symbol lie together.
        values, begin = np.unique(symbols, return_index=True)
        self.starts = np.zeros(1 << self.bits, np.int64)
        self.starts[values] = begin

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            up = ones.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + up, at - up)
        return at - self.starts[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling."""
    size = len(text)
    rank = text.astype(np.int64)
    step = 1
    while True:
        following = np.zeros(size, np.int64)
        following[: size - step] = rank[step:] + 1 if step < size else 0
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        changed = np.empty(size, np.int64)
        changed[0] = 0
        np.cumsum(key[order][1:] != key[order][:-1], out=changed[1:])
        rank = np.empty(size, np.int64)
        rank[order] = changed
        step *= 2
        if step >= depth or changed[-1] == size - 1:
            return order


class FMIndex:
    """Index of segments of symbols 1 and up; 0 parts them. ``depth`` bounds the pattern length."""

    def __init__(self, segments: np.ndarray, lengths: np.ndarray, depth: int):
        """``segments``: the symbols of all segments one after the other, ``lengths`` of them."""
        ends = np.cumsum(lengths)
        self.text = np.insert(segments, ends, 0)
        self.first = np.concatenate([[0], (ends + np.arange(1, len(lengths) + 1))[:-1]])
        self.order = suffix_order(self.text, depth)
        size = int(self.text.max(initial=0)) + 1
        self.tree = WaveletTree(self.text[self.order - 1], size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=size))])

    def search(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns of ``length`` symbols that begin at ``starts`` of the text.

        All patterns are extended to the left together. One whose range holds a single suffix
        cannot match anything but itself and is left at that; its range is given as empty.
        """
        last = self.text[starts + length - 1]
        low, high = self.smaller[last], self.smaller[last + 1]
        live = np.flatnonzero(high - low > 1)
        out_low, out_high = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        low, high = low[live], high[live]
        for back in range(length - 2, -1, -1):
            symbol = self.text[starts[live] + back]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = self.smaller[symbol] + both[: len(symbol)], self.smaller[symbol] + both[len(symbol) :]
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            if not len(live):
                break
        out_low[live], out_high[live] = low, high
        return out_low, out_high
