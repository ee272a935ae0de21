"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Training words stream through it; at each
word it knows the longest run ending there that occurs in an item, so a run of at least ``window``
words marks all its words. An item shorter than the window counts as one window of its own length.
Words are lower-cased runs of ASCII letters, digits and characters outside ASCII, compared by
64-bit fingerprints. Runs of document words that all occur in items are found with numpy; only
those long enough to hold a window enter the automaton.

Distinct items are gathered in blocks of about ``BLOCK_BYTES`` of text, so the automaton a task holds
is bounded however large the benchmark is; documents pass the blocks one after the other without a
shuffle. Null and empty texts have no words and no hits; an item without words is no window; an
item whose id is null marks words but is not listed. Repeated items count once per id, repeated
documents give repeated rows, empty tables give no rows or no hits. Other columns are ignored by
``find_overlaps`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.tables import plain_names, small_batches, texts
from pickwise.llm.words import ALNUM, LOWER, hashes, row_blocks, spans, utf8
from pickwise.workspace import materialize

WINDOW = 10
#: Text of test items that one automaton holds at most (and the largest broadcast).
BLOCK_BYTES = 8 << 20
#: Share of a document's words above which no part of it is kept.
MAX_COVERAGE = 0.5


class SuffixAutomaton:
    """States of all runs of words of the items; word numbers are the edges."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        self.words = np.unique(np.concatenate([w for _, w in items] or [np.zeros(0, np.uint64)]))
        self.edges: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(name, self.numbers(w).tolist()) for name, w in items if len(w)]
        self.shortest = min([window, *(len(w) for _, w in numbered)])
        for _, word_numbers in numbered:
            last = 0
            for number in word_numbers:
                last = self._extend(last, number)
        self.items_of: dict[int, set] = {}
        self.short_items: dict[int, list[tuple[int, str | None]]] = {}
        for name, word_numbers in numbered:
            if len(word_numbers) < window:
                state = 0
                for number in word_numbers:
                    state = self.edges[state][number]
                self.short_items.setdefault(state, []).append((len(word_numbers), name))
            else:
                for at, (state, _) in enumerate(self.walk(word_numbers)):
                    if at >= window - 1:
                        self.items_of.setdefault(self.window_state(state), set()).add(name)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words that no item has."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == words, at, -1)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.edges.append(edges)
        return len(self.length) - 1

    def _split(self, parent: int, number: int, child: int) -> int:
        """The part of ``child`` that follows ``parent`` as a state of its own."""
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.edges[child]))
        self.link[child] = copy
        while parent >= 0 and self.edges[parent].get(number) == child:
            self.edges[parent][number] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, number: int) -> int:
        child = self.edges[last].get(number)
        if child is not None:
            if self.length[child] == self.length[last] + 1:
                return child
            return self._split(last, number, child)
        new = self._state(self.length[last] + 1, 0, {})
        parent = last
        while parent >= 0 and number not in self.edges[parent]:
            self.edges[parent][number] = new
            parent = self.link[parent]
        if parent >= 0:
            child = self.edges[parent][number]
            if self.length[child] == self.length[parent] + 1:
                self.link[new] = child
            else:
                self.link[new] = self._split(parent, number, child)
        return new

    def walk(self, numbers: list[int]) -> Iterator[tuple[int, int]]:
        """Per word the state and length of the longest run ending there that an item has."""
        edges, link, length = self.edges, self.link, self.length
        state = size = 0
        for number in numbers:
            while state and number not in edges[state]:
                state = link[state]
                size = length[state]
            after = edges[state].get(number)
            if after is None:
                size = 0
            else:
                state, size = after, size + 1
            yield state, size

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a longer run."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def hits(self, numbers: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges inside occurrences of windows, and the items that have them."""
        ranges: list[tuple[int, int]] = []
        items: set = set()
        for at, (state, size) in enumerate(self.walk(numbers)):
            reach = 0
            if size >= self.window:
                reach = size
                items |= self.items_of.get(self.window_state(state), set())
            if self.short_items:
                above, left = state, size
                while above > 0:
                    for length, name in self.short_items.get(above, ()):
                        if length <= left:
                            reach = max(reach, length)
                            items.add(name)
                    above = self.link[above]
                    left = self.length[above]
            if reach:
                begin = at + 1 - reach
                while ranges and ranges[-1][1] >= begin:
                    begin = min(begin, ranges.pop()[0])
                ranges.append((begin, at + 1))
        return ranges, items


def _lower_words(column: pa.Array):
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, ALNUM)
    return hashes(data, starts, ends), starts, ends, first, offsets


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The distinct items as (id, word fingerprints) lists, each of about ``block_bytes`` of text at most.

    Repeated rows would all fall into one block.
    """
    plain = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    plain = materialize(plain.distinct(), "items")
    total = plain.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    count = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for number in range(count):
        rows = plain.filter(block == number).collect()
        words, _, _, first, _ = _lower_words(pa.array([r["text"] for r in rows], pa.string()))
        names = [r["item_id"] for r in rows]
        yield [(n, words[a:b].copy()) for n, a, b in zip(names, first, first[1:])]


_BUILT: dict[str, SuffixAutomaton] = {}


def _built(key: str, holder, window: int) -> SuffixAutomaton:
    """The automaton of a broadcast block, kept from task to task of a Python worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = SuffixAutomaton(holder.value, window)
    return _BUILT[key]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _overlaps(column: pa.Array, automaton: SuffixAutomaton):
    """Word count, hit word ranges and items of each text, and where the words stand."""
    words, starts, ends, first, offsets = _lower_words(column)
    numbers = automaton.numbers(words)
    rows = len(first) - 1
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    items: list[set] = [set() for _ in range(rows)]
    known = (numbers >= 0).view(np.uint8)
    marks = np.ones(256, bool)
    marks[0] = False
    begins, stops, _ = spans(known, first, marks)
    long = stops - begins >= automaton.shortest
    row_of = np.searchsorted(first, begins, "right") - 1
    for begin, stop, row in zip(begins[long].tolist(), stops[long].tolist(), row_of[long].tolist()):
        found, names = automaton.hits(numbers[begin:stop].tolist())
        shift = begin - int(first[row])
        ranges[row] += [(a + shift, b + shift) for a, b in found]
        items[row] |= names
    return np.diff(first), ranges, items, (starts, ends, first, offsets)


HITS = "array<struct<start:int,end:int>>"
_RANGE = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _unmarked(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with columns for word count, hit ranges and item ids under the given names."""
    empty = [F.lit(0), F.lit(None).cast(HITS), F.lit(None).cast("array<string>")]
    return small_batches(docs).withColumns(dict(zip(names, empty)))


def _markers(items: DataFrame, window: int, block_bytes: int, names: list[str]) -> Iterator:
    """For each block of items a function that fills in the columns of ``_unmarked`` in batches of rows."""
    spark = items.sparkSession
    words, hits, ids = names
    for block in item_blocks(items, block_bytes):
        holder, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, holder=holder, key=key):
            automaton = _built(key, holder, window)
            for batch in row_blocks(batches, "text"):
                counts, ranges, found, _ = _overlaps(batch.column("text"), automaton)
                old_hits = batch.column(hits).to_pylist()
                old_ids = batch.column(ids).to_pylist()
                ranges = [
                    _merged(new + [(x["start"], x["end"]) for x in old or []])
                    for new, old in zip(ranges, old_hits)
                ]
                listed = [
                    sorted({x for x in new if x is not None} | set(old or []))
                    for new, old in zip(found, old_ids)
                ]
                new = {
                    words: pa.array(counts, pa.int32()),
                    hits: pa.array(
                        [[{"start": a, "end": b} for a, b in r] for r in ranges], pa.list_(_RANGE)
                    ),
                    ids: pa.array(listed, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(
                    [new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names
                )

        yield run


def find_overlaps(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id``, ``n_words``, ``hits`` (word ranges, end exclusive) and ``item_ids`` per row."""
    names = ["n_words", "hits", "item_ids"]
    marked = _unmarked(texts(docs), names)
    for mark in _markers(items, window, block_bytes, names):
        marked = marked.mapInArrow(mark, marked.schema)
    return marked.select("doc_id", *names)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the hit spans, and without rows whose hits exceed ``max_coverage``.

    Other rows and columns, whatever their names, stay as they are. The white space on both sides of a
    removed span stays.
    """
    names = ["__words", "__hits", "__items"]
    plain = plain_names(docs, "text")
    marked = _unmarked(plain, names)
    *others, last = _markers(items, window, block_bytes, names)
    for mark in others:
        marked = marked.mapInArrow(mark, marked.schema)

    # The last block's marks are cut out by the same Python worker: another one would need memory, too.
    def run(batches):
        for batch in last(batches):
            ranges, counts = batch.column("__hits").to_pylist(), batch.column("__words").to_pylist()
            covered = [sum(x["end"] - x["start"] for x in hit) for hit in ranges]
            few = [n <= max_coverage * words for n, words in zip(covered, counts)]
            batch = batch.filter(pa.array(few, pa.bool_()))
            ranges = [hit for hit, keep in zip(ranges, few) if keep]
            cleaned = batch.column("text")
            if any(ranges):
                _, starts, ends, first, offsets = _lower_words(cleaned)
                new = cleaned.to_pylist()
                for row, hit in enumerate(ranges):
                    if hit:
                        data, base, kept, at = new[row].encode(), offsets[row], [], 0
                        for x in hit:
                            kept.append(data[at : starts[first[row] + x["start"]] - base])
                            at = ends[first[row] + x["end"] - 1] - base
                        new[row] = b"".join([*kept, data[at:]]).decode()
                cleaned = pa.array(new, cleaned.type)
            columns = [c for c in batch.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays(
                [cleaned if c == "text" else batch.column(c) for c in columns], columns
            )

    return marked.mapInArrow(run, plain.schema).toDF(*docs.columns)


def digests(overlaps: DataFrame) -> DataFrame:
    """Counts, the digest of the item ids and the verdict."""
    hit = F.expr("aggregate(hits, 0L, (n, x) -> n + x.end - x.start)")
    return overlaps.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
