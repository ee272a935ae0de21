"""Words of whole text columns as numpy arrays, without a Python object per word.

All functions work on the UTF-8 bytes of an Arrow string column. Words are given by a table of 256
flags, one per byte, so every non-ASCII character is either wholly inside or wholly outside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into numpy arrays at a time. A longer text goes alone.
BLOCK_BYTES = 4 << 20

#: Words between white space: space and the control characters 9 to 13.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Words of letters and digits; everything outside ASCII counts as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text whose words are hashed at a time. A longer word goes alone.
HASHED_BYTES = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a one-to-one map)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_POWERS = _powers(_MULTIPLIER, 1 << 10)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def row_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES):
    """The batches cut into smaller ones of about ``limit`` bytes of text."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        for begin, end in blocks(offsets, limit):
            yield batch.slice(begin, end - begin)


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Byte ranges of the words, and the number of words before each text (one entry more)."""
    inside = is_word[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number per word, the same for the same bytes wherever they stand.

    Words come in order and do not overlap. Memory beyond the result is bounded by ``HASHED_BYTES``
    and the longest word, and none of it is kept.
    """
    out = np.empty(len(starts), np.uint64)
    row = 0
    while row < len(starts):
        last = max(int(np.searchsorted(ends, starts[row] + HASHED_BYTES, "right")), row + 1)
        begin, end = starts[row], ends[last - 1]
        at, stop = starts[row:last] - begin, ends[row:last] - begin
        longest = int((stop - at).max())
        powers = _POWERS if longest <= len(_POWERS) else _powers(_MULTIPLIER, longest)
        # Places are counted from the start of each word; those behind its end are of no account.
        places = np.arange(end - begin) - np.repeat(at, np.diff(at, append=end - begin))
        np.minimum(places, len(powers) - 1, out=places)
        sums = np.zeros(end - begin + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[begin:end]] * powers[places], out=sums[1:])
        out[row:last] = sums[stop] - sums[at]
        row = last
    return mix(out)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number per run of ``size`` words; the caller leaves out runs over a text's end."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = words[:count].copy()
    for j in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[j : j + count]
    return mix(out)


def gram_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Flags of the words at which a run of ``size`` words of one text begins."""
    total = int(first[-1])
    count = max(total - size + 1, 0)
    inside = np.ones(count, bool)
    for back in range(1, size):
        edge = first[1:-1] - back
        edge = edge[(edge >= 0) & (edge < count)]
        inside[edge] = False
    return inside
