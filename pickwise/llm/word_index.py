"""A bidirectional FM-index over a delimited vocabulary, and its search with one error.

All words stand in one text, ``#w1#w2#...#wn#``. One index is over that text and one over its mirror image.
A pattern is kept as two ranges of suffix ranks of equal size, one in each index: a step to the left narrows
the range in the first index and moves the other along, a step to the right does it the other way round.

The search scheme has two halves. A word that differs from a pattern by one error holds the pattern's left
half unchanged at its beginning, or the right half at its end. So ``#`` and one half are matched exactly, and
the range is then extended across the other half, where one error may happen at each place. All patterns of
a call are searched together, as numpy arrays.
"""

from __future__ import annotations

import numpy as np

from pickwise.llm.fm_index import WaveletTree

#: Patterns that are extended together.
TOGETHER = 1 << 13


def suffix_order(text: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, symbols of ``bits`` bits.

    As many symbols as fit a number are compared at once, the rest by doubling.
    """
    size, step = len(text), max(1, 62 // bits)
    padded = np.concatenate([text, np.zeros(step, np.int64)])
    key = np.zeros(size, np.int64)
    for k in range(step):
        key = key << bits | padded[k : k + size]
    while True:
        order = np.argsort(key, kind="stable")
        ranks = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        if step >= depth or ranks[-1] == size - 1:
            return order
        rank = np.empty(size, np.int64)
        rank[order] = ranks
        following = np.zeros(size, np.int64)
        following[: max(0, size - step)] = rank[step:] + 1
        key = rank * (size + 1) + following
        step *= 2


class Symbols(WaveletTree):
    """The wavelet tree with what a search in two directions needs."""

    def narrow(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Ranks of ``symbol`` at both ends of each range, and how many smaller symbols lie inside."""
        n, smaller = len(symbol), np.zeros(len(symbol), np.int64)
        both = np.concatenate([low, high])
        for shift, ones, zeros in self.levels:
            up = ones.rank(both)
            bit = ((symbol >> shift) & 1).astype(bool)
            down = both - up
            smaller += np.where(bit, down[n:] - down[:n], 0)
            both = np.where(np.concatenate([bit, bit]), zeros + up, down)
        both -= np.tile(self.starts[symbol], 2)
        return both[:n], both[n:], smaller

    def inside(self, low: np.ndarray, high: np.ndarray):
        """Every different symbol of each range: range number, symbol and its ranks at both ends."""
        of, symbol = np.arange(len(low)), np.zeros(len(low), np.int64)
        for _, ones, zeros in self.levels:
            low_up, high_up = ones.rank(low), ones.rank(high)
            of = np.concatenate([of, of])
            symbol = np.concatenate([symbol << 1, (symbol << 1) + 1])
            low, high = (
                np.concatenate([low - low_up, zeros + low_up]),
                np.concatenate([high - high_up, zeros + high_up]),
            )
            full = high > low
            of, symbol, low, high = of[full], symbol[full], low[full], high[full]
        return of, symbol, low - self.starts[symbol], high - self.starts[symbol]


class _Side:
    """The index of one reading direction: extends a pattern at the front of what it reads."""

    def __init__(self, text: np.ndarray, depth: int, bits: int):
        self.order = suffix_order(text, depth, bits)
        self.ranks = Symbols(text[self.order - 1], 1 << bits)


class WordIndex:
    """Both sides for words that are given as one array of symbols from 1 on, and their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, bits: int):
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        self.symbols = symbols
        text = np.insert(symbols, np.concatenate([[0], ends]), 0).astype(np.int64)
        depth = int(lengths.max(initial=0)) + 2
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        delimiters = np.concatenate([[0], ends + np.arange(1, len(lengths) + 1)])
        # The word that follows the delimiter at a place, and the one that stands in front of it.
        after, before = np.full(len(text), -1), np.full(len(text), -1)
        after[delimiters[:-1]] = before[delimiters[1:]] = np.arange(len(lengths))
        self.sides = [_Side(text, depth, bits), _Side(text[::-1], depth, bits)]
        # Where a match of the whole word begins in the text that its last step has read.
        self.words = [after, before[::-1]]

    def near(self, patterns: Patterns, heads: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word) where the word has the pattern's first ``heads`` symbols and one error
        behind them; with ``mirrored`` both are read from the right. Each pair comes once."""
        found = [np.zeros(0, np.int64)]
        words = len(self.words[0])
        for begin in range(0, len(heads), TOGETHER):
            at = np.arange(begin, min(begin + TOGETHER, len(heads)))
            pattern, word = self._search(patterns, at, heads[at], mirrored)
            found.append(np.unique(pattern * words + word))
        pairs = np.concatenate(found)
        return pairs // words, pairs % words

    def _exact(self, patterns: Patterns, at: np.ndarray, heads: np.ndarray, mirrored: bool):
        """Ranges of ``#`` and the heads, matched from the head's last symbol to its first and ``#``."""
        near, first = self.sides[mirrored], self.first
        symbol = patterns.symbol(at, heads - 1)
        low, high = first[symbol], first[symbol + 1]
        other = low.copy()
        place = heads - 2
        live = np.flatnonzero((high > low) & (place >= -1))
        while len(live):
            symbol = np.where(place[live] >= 0, patterns.symbol(at[live], np.maximum(place[live], 0)), 0)
            a, b, smaller = near.ranks.narrow(symbol, low[live], high[live])
            low[live], high[live] = first[symbol] + a, first[symbol] + b
            other[live] += smaller
            place[live] -= 1
            live = live[(high[live] > low[live]) & (place[live] >= -1)]
        return other, other + (high - low)

    def _search(self, patterns: Patterns, at: np.ndarray, heads: np.ndarray, mirrored: bool):
        far, first = self.sides[not mirrored], self.first
        place_word = self.words[not mirrored]
        low, high = self._exact(patterns, at, heads, mirrored)
        place = heads.copy()
        live = high > low
        at, place, low, high = at[live], place[live], low[live], high[live]
        # Patterns that have met their error and must match from here on.
        bound = [np.zeros(0, np.int64)] * 4
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at) or len(bound[0]):
            new = []
            if len(at):
                expected = patterns.symbol(at, place)
                of, symbol, a, b = far.ranks.inside(low, high)
                a, b = first[symbol] + a, first[symbol] + b
                wrong = (symbol != 0) & (symbol != expected[of])
                of, a, b = of[wrong], a[wrong], b[wrong]
                more = expected[of] != 0
                # Another symbol instead of the expected one, one too many in front of it, or none.
                # Of equal symbols in a row, the last counts as the missing or the additional one.
                new.append((at[of[more]], place[of[more]] + 1, a[more], b[more]))
                new.append((at[of], place[of], a, b))
                skip = (expected != 0) & (patterns.symbol(at, place + (expected != 0)) != expected)
                new.append((at[skip], place[skip] + 1, low[skip], high[skip]))
                at, place, low, high, _ = self._step(far, patterns, at, place, low, high)
            b_at, b_place, b_low, b_high, ended = self._step(far, patterns, *bound)
            done.append((ended[0], place_word[far.order[ended[1]]]))
            bound = [np.concatenate(x) for x in zip((b_at, b_place, b_low, b_high), *new)]
        return (np.concatenate(x) for x in zip(*done)) if done else (at, at)

    def _step(self, far: _Side, patterns: Patterns, at, place, low, high):
        """Match the next symbol. Patterns that match ``#`` are at their end and given apart."""
        symbol = patterns.symbol(at, place)
        a, b, _ = far.ranks.narrow(symbol, low, high)
        low, high = self.first[symbol] + a, self.first[symbol] + b
        full = high > low
        more, end = full & (symbol != 0), full & (symbol == 0)
        return at[more], place[more] + 1, low[more], high[more], (at[end], low[end])


class Patterns:
    """Words to search for, in one reading direction; 0 follows each."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        self.flat = np.insert(symbols, ends, 0).astype(np.int64)
        self.starts = ends - lengths + np.arange(len(lengths))

    def symbol(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.flat[self.starts[at] + place]


def mirrored(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each word's symbols from the last to the first."""
    ends = np.cumsum(lengths)
    each = np.repeat(np.arange(len(lengths)), lengths)
    return symbols[(ends - lengths)[each] + ends[each] - 1 - np.arange(len(symbols))]
