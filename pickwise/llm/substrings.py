"""Removal of repeated word windows with an FM-index per shard.

A word goes if it lies in a window of ``WINDOW`` words that also starts earlier: in a document
with a smaller id, or earlier in the same one.

1. Equal texts are one class, represented by its smallest id: all words of a later copy go if it has
   a window at all. Only classes go on.
2. Every window has an anchor, the run of ``ANCHOR`` words in it with the least hash. Neighbouring
   windows with the same anchor form a segment; equal windows have equal anchors, so segments
   with different anchors have no window in common. Only fingerprints of segments are sent to the
   shard of their anchor. Equal segments are summed up there, and before that in every task, to
   their earliest place; at all other places every window starts later, so the segment goes.
3. Where an anchor has different segments, their words are fetched and every shard builds an FM-index
   (suffix order, BWT in a wavelet tree of packed bits) of them. The segments are streamed through it by
   backward search; a window that the index holds more than once goes everywhere but at its
   earliest place.
4. The intervals of a class come together and its text is cut.

An anchor that too many different segments share (the edges of a passage that many documents hold) is
replaced by the windows' own fingerprints, so no shard gathers what the data make hot. Fingerprints
have 64 bits. Words are compared as they are. Null and empty texts have no words. A null id comes
after all others and is one document; rows that share an id are one document, whose texts begin at
the same place; repeated rows get equal results. An empty table gives no rows; other columns are
ignored. Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.fm_index import FMIndex
from pickwise.llm.words import SPACED, blocks, gram_hashes, gram_starts, hashes, mix, spans, utf8
from pickwise.operators.skew import hot_keys, split_join
from pickwise.workspace import materialize

WINDOW = 20
ANCHOR = 8
#: Bytes of text per shard.
SHARD_BYTES = 16 << 20
#: Different segments of one anchor above which its windows are spread over all shards.
HOT_SEGMENTS = 1 << 20
#: Place of rows without an id.
_LAST = np.iinfo(np.int64).max
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
REMOVED, WANTED = 0, 1


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    return b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)])


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    at = 8 * (1 + len(kinds))
    out = []
    for size, kind in zip(np.frombuffer(blob, np.int64, len(kinds), 8).tolist(), kinds):
        out.append(np.frombuffer(blob[at : at + size], kind))
        at += size
    return out


def _run_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A fingerprint of each run of words, from prefix sums."""
    count = len(words)
    powers = np.full(count + 1, _BASE, np.uint64)
    powers[0] = 1
    inverse = np.full(count + 1, _INVERSE, np.uint64)
    inverse[0] = 1
    powers, inverse = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(words * powers[:count], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64))


def _segments(words: np.ndarray, first: np.ndarray, hot: np.ndarray):
    """Anchor, fingerprint, text number, start in the text and window count of every segment."""
    count = len(words) - WINDOW + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    grams = gram_hashes(words, ANCHOR)
    best, place = grams[:count].copy(), np.zeros(count, np.int64)
    for step in range(1, WINDOW - ANCHOR + 1):
        later = grams[step : step + count]
        less = later < best
        best[less] = later[less]
        place[less] = step
    at = np.flatnonzero(gram_starts(first, WINDOW))
    anchor, place = best[at], place[at] + at
    row = np.searchsorted(first, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    is_hot = np.isin(anchor, hot) if len(hot) else np.zeros(len(at), bool)
    new |= is_hot
    begin = np.flatnonzero(new)
    windows = np.diff(np.append(begin, len(at)))
    starts, anchor, row = at[begin], anchor[begin], row[begin]
    content = _run_hashes(words, starts, windows + WINDOW - 1)
    anchor = np.where(is_hot[begin], content, anchor)
    return anchor, content, row, starts - first[row], windows


def _earliest(content: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Flags of the places of each content that no other place of it comes before."""
    order = np.lexsort((start, doc, content))
    c, d, s = content[order], doc[order], start[order]
    head = np.ones(len(c), bool)
    head[1:] = c[1:] != c[:-1]
    which = np.cumsum(head) - 1
    firsts = np.flatnonzero(head)
    out = np.empty(len(c), bool)
    out[order] = (d == d[firsts][which]) & (s == s[firsts][which])
    return out


def _texts_of(batch: pa.RecordBatch):
    """Word fingerprints of the texts of a batch in blocks, with row offsets."""
    data, offsets = utf8(batch.column("text"))
    for begin, end in blocks(offsets):
        part = data[offsets[begin] : offsets[end]]
        starts, ends, first = spans(part, offsets[begin : end + 1] - offsets[begin], SPACED)
        yield begin, part, starts, ends, first, hashes(part, starts, ends)


def _batch_segments(batch: pa.RecordBatch, hot: np.ndarray):
    parts = []
    for begin, _, _, _, first, words in _texts_of(batch):
        anchor, content, row, start, windows = _segments(words, first, hot)
        parts.append((anchor, content, row + begin, start, windows))
    return [np.concatenate(x) for x in zip(*parts)] if parts else None


def _docs_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _keys_of(batch: pa.RecordBatch) -> np.ndarray:
    """The 16-byte class keys as two numbers each."""
    return np.frombuffer(b"".join(batch.column("key").to_pylist()), np.int64).reshape(-1, 2)


def _blob_rows(shard: np.ndarray, make, most: int = 1 << 40) -> Iterator[tuple[int, bytes]]:
    """Blobs of the entries that go to each shard, of at most so many each."""
    order = np.argsort(shard, kind="stable")
    values, begin = np.unique(shard[order], return_index=True)
    for value, part in zip(values.tolist(), np.split(order, begin[1:])):
        for at in range(0, len(part), most):
            yield value, make(part[at : at + most])


def _as_batch(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[] for _ in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kind) for v, kind in zip(values, columns.values())], list(columns)
    )


_BLOBS = {"shard": pa.int32(), "blob": pa.binary()}
_ENTRIES = ("<u4", "<u8", "<u2", "<u4", "<u1", "<i8", "<i8")
#: ``place`` holds a run of windows in one number: shard, first word (4 bytes) and windows (1 byte).
PIECES = "key binary, kind byte, place long"
#: Rows of a blob that refer to texts by two bytes.
_MOST_ROWS = 1 << 15


def _hot_anchors(docs: DataFrame, shards: int) -> np.ndarray:
    """Anchors with more than ``HOT_SEGMENTS`` segments that differ, at least within every task.

    At most one per ``HOT_SEGMENTS`` segments can qualify.
    """

    def run(batches):
        for batch in batches:
            found = _batch_segments(batch, np.zeros(0, np.uint64))
            if found is None:
                continue
            _, one = np.unique(found[1], return_index=True)
            anchors, counts = np.unique(found[0][one], return_counts=True)
            make = lambda part: _pack(anchors[part], counts[part])  # noqa: B023, E731
            yield _as_batch(_BLOBS, list(_blob_rows((anchors % np.uint64(shards)).astype(np.int32), make)))

    def total(batches):
        found = [_unpack(b, "<u8", "<i8") for batch in batches for b in batch.column("blob").to_pylist()]
        if found:
            anchors, at = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([x[1] for x in found]))
            hot = anchors[counts > HOT_SEGMENTS].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hot)], ["anchor"])

    counted = docs.mapInArrow(run, "shard int, blob binary").repartitionById(shards, "shard")
    rows = counted.mapInArrow(total, "anchor long").collect()
    return np.sort(np.array([r["anchor"] for r in rows], np.int64).astype(np.uint64))


def _fingerprints(classes: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Blobs of segment fingerprints per shard; what is known to go already rides along."""

    def run(batches):
        for whole in batches:
            for begin in range(0, max(len(whole), 1), _MOST_ROWS):
                batch = whole.slice(begin, _MOST_ROWS)
                found = _batch_segments(batch, hot)
                if found is None:
                    continue
                anchor, content, row, start, windows = found
                docs, keys = _docs_of(batch), _keys_of(batch)
                kept = _earliest(content, docs[row], start)
                # Later places within the task need no anchor any more; they go where their text's number says.
                shard = np.where(kept, anchor % np.uint64(shards), row.astype(np.uint64) % np.uint64(shards))

                def make(part, known=(anchor, content, row, start, windows, kept, docs, keys)):
                    anchor, content, row, start, windows, kept, docs, keys = known
                    part = part[np.argsort(~kept[part], kind="stable")]
                    rows, ref = np.unique(row[part], return_inverse=True)
                    live = int(kept[part].sum())
                    return _pack(
                        # A shard has one residue of its anchors, so it needs only what is left of them.
                        (anchor[part[:live]] // np.uint64(shards)).astype(np.uint32), content[part[:live]],
                        ref.astype(np.uint16),
                        start[part].astype(np.uint32), windows[part].astype(np.uint8), docs[rows],
                        keys[rows].reshape(-1),
                    )

                yield _as_batch(_BLOBS, list(_blob_rows(shard.astype(np.int32), make)))

    sent = classes.select("key", "doc_id", "text").mapInArrow(run, "shard int, blob binary")
    return sent.repartitionById(shards, "shard").sortWithinPartitions("shard")


def _by_shard(batches: Iterator[pa.RecordBatch], *kinds: str):
    """All blobs of one shard at a time, each array concatenated, with the size of each blob's parts."""
    current, blobs = None, []
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist()):
            if shard != current and blobs:
                yield current, blobs
                blobs = []
            current = shard
            blobs.append(_unpack(blob, *kinds))
    if blobs:
        yield current, blobs


def _pieces(fingerprints: DataFrame) -> DataFrame:
    """Segments that go, and those whose words the index needs, by class key."""

    def run(batches):
        for shard, blobs in _by_shard(batches, *_ENTRIES):
            parts = []
            for anchor, content, ref, start, windows, docs, keys in blobs:
                live, ref = len(anchor), ref.astype(np.int64)
                keys = keys.reshape(-1, 2)[ref]
                parts.append(
                    (anchor, content, docs[ref][:live], start[:live].astype(np.int64), windows[:live], keys[:live],
                     start[live:], windows[live:], keys[live:])
                )
            anchor, content, docs, start, windows, keys, late_start, late_windows, late_keys = (
                np.concatenate(x) for x in zip(*parts)
            )
            first = _earliest(content, docs, start)
            gone = ~first
            # A first place is wanted if its anchor has another content.
            names, which = np.unique(anchor, return_inverse=True)
            low = np.full(len(names), np.iinfo(np.uint64).max, np.uint64)
            high = np.zeros(len(names), np.uint64)
            np.minimum.at(low, which, content)
            np.maximum.at(high, which, content)
            wanted = first & (low != high)[which]
            for kind, some, s, w, k in (
                (REMOVED, gone, start, windows, keys),
                (WANTED, wanted, start, windows, keys),
                (REMOVED, np.ones(len(late_start), bool), late_start, late_windows, late_keys),
            ):
                if some.any():
                    yield _piece_batch(k[some], kind, s[some], w[some], shard)

    return fingerprints.mapInArrow(run, PIECES)


def _piece_batch(keys, kind, start, windows, shard=0) -> pa.RecordBatch:
    raw = np.ascontiguousarray(keys).tobytes()
    count = len(start)
    key = pa.Array.from_buffers(pa.binary(16), count, [None, pa.py_buffer(raw)]).cast(pa.binary())
    place = (shard << 40) | (np.asarray(start, np.int64) << 8) | np.asarray(windows, np.int64)
    return pa.RecordBatch.from_arrays(
        [key, pa.array(np.full(count, kind, np.int8)), pa.array(place)], ["key", "kind", "place"]
    )


def _places(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word, windows and shard of every place in the lists."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    return row, (place >> 8) & 0xFFFFFFFF, place & 0xFF, place >> 40


_WORDS = ("<i8", "<u1", "<u4", "<i8", "<i8", "<u8", "<u2")
#: Segments of a blob whose different words can be numbered by two bytes.
_MOST_SEGMENTS = 2000


def _wanted_words(classes: DataFrame, pieces: DataFrame, shards: int) -> DataFrame:
    """Blobs of the words of wanted segments per shard of their anchor."""
    wanted = pieces.filter(F.size("wanted") > 0).select("key", "wanted")
    joined = classes.join(wanted, "key").select("key", "doc_id", "text", "wanted")

    def run(batches):
        for batch in batches:
            docs, keys = _docs_of(batch), _keys_of(batch)
            lists = batch.column("wanted")
            for begin, _, _, _, first, words in _texts_of(batch):
                rows = len(first) - 1
                row, start, windows, shard = _places(lists.slice(begin, rows))
                absolute, row = start + first[row], row + begin

                def make(part, known=(absolute, windows, start, row, docs, keys, words)):
                    absolute, windows, start, row, docs, keys, words = known
                    length = windows[part] + WINDOW - 1
                    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                    taken = words[np.repeat(absolute[part], length) + inner]
                    values, codes = np.unique(taken, return_inverse=True)
                    return _pack(
                        docs[row[part]], windows[part].astype(np.uint8), start[part].astype(np.uint32),
                        keys[row[part], 0].copy(), keys[row[part], 1].copy(), values, codes.astype(np.uint16),
                    )

                rows_out = _blob_rows(shard.astype(np.int32), make, _MOST_SEGMENTS)
                yield _as_batch(_BLOBS, list(rows_out))

    sent = joined.mapInArrow(run, "shard int, blob binary")
    return sent.repartitionById(shards, "shard").sortWithinPartitions("shard")


def repeated_windows(docs, start, windows, words) -> np.ndarray:
    """Flags of the windows of segments that an earlier equal window has, in segment order.

    ``docs``, ``start``, ``windows`` give each segment's place; ``words`` are all their words.
    """
    _, numbers = np.unique(words, return_inverse=True)
    length = windows + WINDOW - 1
    index = FMIndex(numbers + 1, length, WINDOW)
    total = int(windows.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    place = np.repeat(index.first, windows) + inner
    low, high = index.search(place, WINDOW)
    # The order of places: equal places have equal numbers.
    doc, at = np.repeat(docs, windows), np.repeat(start, windows) + inner
    order = np.lexsort((at, doc))
    new = np.zeros(total, np.int64)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (at[order][1:] != at[order][:-1])
    age = np.empty(total, np.int64)
    age[order] = np.cumsum(new)
    out = np.zeros(total, bool)
    hit = np.flatnonzero(high > low)
    if len(hit):
        by_place = np.full(len(index.text), total + 1, np.int64)
        by_place[place] = age
        ages = np.append(by_place[index.order], total + 1)
        lows, which = np.unique(low[hit], return_inverse=True)
        highs = np.zeros(len(lows), np.int64)
        highs[which] = high[hit]
        oldest = np.minimum.reduceat(ages, np.stack([lows, highs], 1).reshape(-1))[::2]
        out[hit] = age[hit] > oldest[which]
    return out


def _matched(words: DataFrame) -> DataFrame:
    """Runs of windows that go, found by each shard's index."""

    def run(batches):
        for _, blobs in _by_shard(batches, *_WORDS):
            docs = np.concatenate([x[0] for x in blobs])
            windows = np.concatenate([x[1] for x in blobs]).astype(np.int64)
            start = np.concatenate([x[2] for x in blobs]).astype(np.int64)
            keys = np.stack([np.concatenate([x[n] for x in blobs]) for n in (3, 4)], 1)
            taken = np.concatenate([x[5][x[6]] for x in blobs])
            gone = repeated_windows(docs, start, windows, taken)
            segment = np.repeat(np.arange(len(windows)), windows)
            inner = np.arange(len(gone)) - np.repeat(np.cumsum(windows) - windows, windows)
            edge = np.ones(len(gone), bool)
            edge[1:] = (segment[1:] != segment[:-1]) | (gone[1:] != gone[:-1])
            begin = np.flatnonzero(edge)
            size = np.diff(np.append(begin, len(gone)))
            begin, size = begin[gone[begin]], size[gone[begin]]
            if len(begin):
                yield _piece_batch(
                    keys[segment[begin]], REMOVED, start[segment[begin]] + inner[begin], size
                )

    return words.mapInArrow(run, PIECES)


_CUT = {"key": pa.binary(), "doc_id": None, "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}


def _cut(classes: DataFrame, gone: DataFrame) -> DataFrame:
    """Each class with its word counts and its kept words, joined by one space."""
    kind = classes.schema["doc_id"].dataType.simpleString()
    joined = classes.join(gone, "key", "left").select("key", "doc_id", "text", "gone")

    def run(batches):
        for batch in batches:
            lists = batch.column("gone")
            counts, removed, kept = [], [], []
            for begin, part, starts, ends, first, _ in _texts_of(batch):
                rows = len(first) - 1
                marks = np.zeros(len(starts) + 1, np.int64)
                row, begins, widths, _ = _places(lists.slice(begin, rows))
                begins, widths = begins + first[row], widths + WINDOW - 1
                np.add.at(marks, begins, 1)
                np.add.at(marks, begins + widths, -1)
                out = np.cumsum(marks[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(out)])
                counts.append(np.diff(first))
                removed.append(sums[first[1:]] - sums[first[:-1]])
                data = part.tobytes()
                for a, b, any_gone in zip(first.tolist(), first[1:].tolist(), removed[-1].tolist()):
                    if not any_gone:
                        left = data[starts[a] : ends[b - 1]].split() if b > a else []
                    else:
                        stay = a + np.flatnonzero(~out[a:b])
                        left = [data[x:y] for x, y in zip(starts[stay].tolist(), ends[stay].tolist())]
                    kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id"),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.array(np.concatenate(removed) if removed else [], pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                list(_CUT),
            )

    return joined.mapInArrow(run, f"key binary, doc_id {kind}, n_words long, n_removed long, kept string")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select("doc_id", text).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))


def cut_classes(docs: DataFrame) -> DataFrame:
    """One row per distinct text: ``key``, smallest ``doc_id``, word counts and kept words.

    The texts are shuffled once, by class; the three joins that need them use that exchange.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    hot = _hot_anchors(docs.select("text"), shards)
    classes = _keyed(docs).groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    found = _pieces(_fingerprints(classes, shards, hot))
    part = lambda kind: F.collect_list(
        F.when(F.col("kind") == kind, F.col("place"))
    )
    pieces = found.groupBy("key").agg(part(REMOVED).alias("gone"), part(WANTED).alias("wanted"))
    matched = _matched(_wanted_words(classes, pieces, shards))
    more = matched.groupBy("key").agg(F.collect_list("place").alias("more"))
    empty = F.array().cast("array<bigint>")
    gone = pieces.select("key", "gone").join(more, "key", "left").select(
        "key", F.concat("gone", F.coalesce("more", empty)).alias("gone")
    )
    return _cut(classes, gone)


def _spread(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The class results on every row of ``docs``: later copies with a window keep nothing."""
    rows = _keyed(docs).select("doc_id", "key")
    counts = rows.groupBy("key").agg(F.count("*").alias("rows"))
    hot = hot_keys(counts, ["key"], "rows")
    named = cut.withColumnRenamed("key", "__key").withColumnRenamed("doc_id", "__first")
    return split_join(rows, named, ["key"], ["__key"], hot=hot).withColumn(
        "__copy", ~F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("n_words") >= WINDOW)
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words of each row."""
    cut = materialize(cut_classes(docs), "cut")
    return _spread(docs, cut).select(
        "doc_id", "n_words",
        F.when(F.col("__copy"), F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(F.col("__copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """As ``remove_repeats`` with a digest of the kept words, made before rows are spread."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    cut = cut_classes(docs).withColumn("kept_sha256", digest(F.col("kept"))).drop("kept")
    return _spread(docs, materialize(cut, "cut")).select(
        "doc_id", "n_words",
        F.when(F.col("__copy"), F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(F.col("__copy"), digest(F.lit(""))).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
