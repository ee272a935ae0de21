"""Byte-pair encoding with forced boundaries, and decoding.

A text is cut into pieces by the pattern of the vocabulary file. Inside a piece, two neighbouring
bytes that stand together in no token of the vocabulary can never be merged over, so the piece is
cut between them for certain: the fragments are encoded independently of each other and the ids
concatenated. Fragments recur far more often than pieces, so their ids are kept in a bounded table
for the length of a task.

Null counts as an empty text and gives no ids. Rows are independent: repeated rows give repeated
results, an empty table gives an empty one, columns other than ``doc_id`` and ``text`` are ignored.
Time and memory are linear in a text's length (up to a logarithm), however long a run without
a cut is.
"""

from __future__ import annotations

import functools
import heapq
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.tables import texts
from pickwise.llm.words import row_blocks

# The pattern that cuts text into pieces before byte-level merges.
PIECES = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"""
)

_NEVER = 1 << 60
#: Code points asked about at a time.
_ASKED = 256

#: Entries of each half of the tables of known pieces and fragments.
KNOWN_PIECES = 1 << 18
#: Bytes of text encoded at a time; every piece of it is an object.
ENCODED_BYTES = 1 << 20
#: Fragments up to this many bytes are merged side by side, so many at a time.
SHORT, TOGETHER = 32, 1 << 14
#: Pieces longer than this many bytes are not kept.
KEPT_BYTES = 64


def _byte_names() -> dict[str, int]:
    """Vocabulary files write each byte as a visible character: itself if printable, else 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


Ranges = tuple[tuple[int, int], ...]


@functools.lru_cache(1)
def classes() -> tuple[Ranges, Ranges]:
    """Letters and numbers as ranges, in the Unicode version of the tokenizers library.

    Packages differ in that version, and by it in thousands of code points. The library is asked: a code
    point is a letter if it stays in one piece with a letter, and a number if it does with a number.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
    inside: dict[str, list[int]] = {"a": [], "1": []}
    for begin in range(0, 0x110000, _ASKED):
        codes = range(begin, begin + _ASKED)
        if 0xD800 <= begin < 0xE000:
            continue
        together = "".join(map(chr, codes))
        if len(cut("a" + together)) == 1:
            inside["a"] += codes
        elif len(cut("." + together)) > 1:  # else they are neither
            for known, found in inside.items():
                pieces = {span for _, span in cut("".join(f"\n{known}{chr(c)}" for c in codes))}
                # A piece of both characters behind a line feed; line feeds are white space.
                found += [begin + k for k in range(_ASKED) if (3 * k + 1, 3 * k + 3) in pieces]
    return _ranges(inside["a"]), _ranges(inside["1"])


def _ranges(codes: list[int]) -> Ranges:
    found: list[list[int]] = []
    for code in codes:
        if found and found[-1][1] == code - 1:
            found[-1][1] = code
        else:
            found.append([code, code])
    return tuple((a, b) for a, b in found)


def _set(ranges: Ranges) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Pieces:
    """The cut of a text into pieces with given classes of letters and numbers.

    The installed package's own classes are faster, and right where no character of a text is one that
    they put elsewhere.
    """

    def __init__(self, letters: Ranges, numbers: Ranges):
        self.exact = regex.compile(PIECES.replace("{L}", _set(letters)).replace("{N}", _set(numbers)))
        self.fast = regex.compile(PIECES.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}"))
        everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        differ: set[str] = set()
        for ranges, pattern in ((letters, r"\p{L}"), (numbers, r"\p{N}")):
            mine = set(map(chr, chain.from_iterable(range(a, b + 1) for a, b in ranges)))
            differ ^= mine ^ set(regex.findall(pattern, everything))
        self.differ = frozenset(differ)

    def findall(self, text: str) -> list[str]:
        if text.isascii() or self.differ.isdisjoint(text):
            return self.fast.findall(text)
        return self.exact.findall(text)


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Vocabulary:
    """Tokens, merges and forced cuts of one vocabulary file.

    Ids are kept and joined as bytes of 32-bit numbers, which take a third of the memory of tuples.
    """

    def __init__(self, path: str, letters: Ranges, numbers: Ranges):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, names = content["model"], _byte_names()
        ids = model["vocab"]
        raw = {token: bytes(map(names.__getitem__, token)) for token in ids}
        self.added = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.packed_added = {token: _packed([i]) for token, i in self.added.items()}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = raw[token]
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = [0] * 256
        together = np.zeros((256, 256), bool)
        for token, i in ids.items():
            data = np.frombuffer(raw[token], np.uint8)
            together[data[:-1], data[1:]] = True
            if len(data) == 1:
                self.byte_ids[data[0]] = i
        self.together = together
        self.pairs_together = {(int(a), int(b)) for a, b in np.argwhere(together)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        # The same as arrays: pairs in order with their ranks, and the id that a rank makes.
        pairs = np.array([(left << 32) + right for left, right in self.merges], np.int64)
        ranks = np.array([rank for rank, _ in self.merges.values()], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], ranks[order]
        self.made = np.zeros(len(model["merges"]) + 1, np.int64)
        self.made[ranks] = [i for _, i in self.merges.values()]
        self.pieces = Pieces(letters, numbers)
        self.marks = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")"
        ) if self.added else None
        self.known = _Known(self.piece_ids, KNOWN_PIECES)
        self.fragments = _Known(self.merge, KNOWN_PIECES)

    def cut(self, data: bytes) -> list[bytes]:
        """The fragments between certain cuts."""
        if len(data) <= KEPT_BYTES:
            together = self.pairs_together
            at = [n for n, pair in enumerate(zip(data, data[1:]), 1) if pair not in together]
        else:
            codes = np.frombuffer(data, np.uint8)
            at = (np.flatnonzero(~self.together[codes[:-1], codes[1:]]) + 1).tolist()
        return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])] if at else [data]

    def piece_ids(self, piece: str) -> bytes:
        return b"".join(map(self.fragments.__getitem__, self.cut(piece.encode())))

    def merge(self, fragment: bytes) -> bytes:
        """Ids of a fragment: the merge of lowest rank first, the leftmost of equals."""
        ids = [self.byte_ids[b] for b in fragment]
        merges = self.merges
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        queue = []
        for at, pair in enumerate(zip(ids, ids[1:])):
            if found := merges.get(pair):
                queue.append((found[0], at, pair, found[1]))
        heapq.heapify(queue)
        while queue:
            _, at, pair, joined = heapq.heappop(queue)
            right = after[at]
            if ids[at] != pair[0] or right < 0 or ids[right] != pair[1]:
                continue
            ids[at], ids[right] = joined, -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
                if found := merges.get(new := (joined, ids[after[at]])):
                    heapq.heappush(queue, (found[0], at, new, found[1]))
            if before[at] >= 0:
                if found := merges.get(new := (ids[before[at]], joined)):
                    heapq.heappush(queue, (found[0], before[at], new, found[1]))
        return _packed([i for i in ids if i >= 0])

    def merge_all(self, fragments: list[bytes]) -> list[bytes]:
        """``merge`` of many short fragments, one merge of each of them at a time.

        A row per fragment has its ids, another the ranks of its pairs; a merge closes the gap in both.
        """
        lengths = np.array([len(f) for f in fragments])
        width, n = int(lengths.max()), len(fragments)
        data = np.frombuffer(b"".join(f.ljust(width, b"\0") for f in fragments), np.uint8).reshape(n, width)
        places = np.arange(width)
        ids = np.where(places < lengths[:, None], np.array(self.byte_ids, np.int64)[data], -1)
        ranks = np.full((n, width), _NEVER)
        ranks[:, :-1] = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        result, live = np.empty_like(ids), np.arange(n)
        while len(live):
            at = ranks.argmin(axis=1)
            rows = np.arange(len(live))
            rank = ranks[rows, at]
            more = rank < _NEVER
            result[live[~more]] = ids[~more]
            live, ids, ranks, at, rank = live[more], ids[more], ranks[more], at[more], rank[more]
            if not len(live):
                break
            rows, gap = rows[: len(live)], places >= at[:, None]
            # Ids behind the pair and ranks from the pair on move up by one place.
            ids = np.where(gap, np.concatenate([ids[:, 1:], np.full((len(live), 1), -1)], axis=1), ids)
            ranks = np.where(gap, np.concatenate([ranks[:, 1:], np.full((len(live), 1), _NEVER)], axis=1), ranks)
            ids[rows, at] = self.made[rank]
            after = np.minimum(at + 1, width - 1)
            ranks[rows, at] = self._pair_ranks(ids[rows, at], np.where(after > at, ids[rows, after], -1))
            left = np.flatnonzero(at > 0)
            before = at[left] - 1
            ranks[left, before] = self._pair_ranks(ids[left, before], ids[left, at[left]])
        ends = 4 * (np.arange(n) * width + (result >= 0).sum(axis=1))
        packed = result.astype(np.int32).tobytes()
        return [packed[a:b] for a, b in zip(range(0, 4 * n * width, 4 * width), ends.tolist())]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 standing for none."""
        pair = (left << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = (self.pairs[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], _NEVER)

    def learn(self, pieces: set[str]) -> None:
        """Cut and merge what is new in these pieces together, so that ``encode`` finds it."""
        older = self.known.older
        new = [p for p in pieces.difference(self.known) if len(p) <= KEPT_BYTES and p not in older]
        if not new:
            return
        raw = [piece.encode() for piece in new]
        data = b"".join(raw)
        codes = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(x) for x in raw])
        begins = np.ones(len(data) + 1, bool)
        begins[1:-1] = ~self.together[codes[:-1], codes[1:]]
        begins[ends] = True
        at = np.flatnonzero(begins)
        fragments = [data[x:y] for x, y in zip(at.tolist(), at[1:].tolist())]
        fresh = {f for f in fragments if f not in self.fragments and len(f) <= SHORT}
        # Of like lengths together.
        fresh = sorted((f for f in fresh if f not in self.fragments.older), key=len)
        for begin in range(0, len(fresh), TOGETHER):
            some = fresh[begin : begin + TOGETHER]
            for fragment, ids in zip(some, self.merge_all(some)):
                self.fragments.put(fragment, ids)
        merged, first = self.fragments, 0
        for piece, last in zip(new, np.searchsorted(at, ends).tolist()):
            if last == first + 1:
                self.known.put(piece, merged[fragments[first]])
            else:
                self.known.put(piece, b"".join(map(merged.__getitem__, fragments[first:last])))
            first = last

    def encode_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        cut = [self.marks.split(text) if self.marks else [text] for text in texts]
        cut = [[x if n % 2 else self.pieces.findall(x) for n, x in enumerate(parts)] for parts in cut]
        self.learn({piece for parts in cut for some in parts[::2] for piece in some})
        out = []
        for parts in cut:
            ids = [
                self.packed_added[part] if n % 2 else b"".join(map(self.known.__getitem__, part))
                for n, part in enumerate(parts)
            ]
            out.append(np.frombuffer(b"".join(ids), np.int32))
        return out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def forget(self) -> None:
        """Empty the table of pieces, for a worker that may next wait for long.

        Fragments take most of the time and less memory, and the next task of the worker needs them.
        """
        self.known.clear()
        self.known.older = {}

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Known(dict):
    """Results by argument, computed when first asked for, bounded in number.

    A full table becomes the older half, and a new one is begun: what is still in use moves over.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= KEPT_BYTES:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value


@functools.lru_cache(2)
def vocabulary(path: str, kinds: tuple[Ranges, Ranges] | None = None) -> Vocabulary:
    return Vocabulary(path, *(kinds or classes()))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` of the whole text and ``decoded``, the text that the ids give.

    ``path`` is the vocabulary file, readable on every executor. Strings of added tokens inside a
    text become those tokens, as in the usual encoders.
    """
    kind, kinds = docs.schema["doc_id"].dataType.simpleString(), classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, kinds)
        for batch in row_blocks(batches, "text", ENCODED_BYTES):
            ids, ends, decoded = [], [0], []
            for found in words.encode_arrays([text or "" for text in batch.column("text").to_pylist()]):
                ids.append(found)
                ends.append(ends[-1] + len(found))
                decoded.append(words.decode(found.tolist()))
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )
        words.forget()
        pa.default_memory_pool().release_unused()

    return texts(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
