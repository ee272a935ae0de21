"""Near-duplicate groups by an inverted join over signature coordinates.

1. Every text becomes its set of word shingles (64-bit fingerprints) and a MinHash signature of
   ``COORDINATES`` values. Texts with the same set form a class, found by an aggregation; only
   classes go on, so copies cost nothing further.
2. Classes are posted under (coordinate, value). A pair that agrees on at least ``MATCHES``
   coordinates must share one of the ``COORDINATES - MATCHES + 1`` rarest entries of either, so
   only that prefix of a class's entries, rarest first, is posted, and entries without a partner
   are never posted (prefix filter). Postings with the same members are merged into one (skip).
3. A posting's members are compared on their full sets. First with the posting's most central
   member, then those that are not linked with it with all others. Large postings are cut into
   blocks of bounded size which all hold the central member; members that are not linked with it
   meet the other blocks in a second pass. Only links that join different groups are emitted, so
   a group of n texts gives about n links, never all pairs, and no component is lost.
4. Components of the links.

A pair at the similarity of 0.8 agrees on fewer than 13 of 32 coordinates about 1.9 times in
10,000,000 (binomial); such a pair is not compared. Null and empty texts have no shingles and are linked with nothing; a text of fewer than
``SHINGLE`` words is one shingle. Rows that share a doc_id but not the text are documents of their
own; repeated rows are copies. A group whose ids are all null has a null id. An empty table gives no
rows; other columns are ignored by ``near_duplicates`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.components import components
from pickwise.llm.tables import plain_names, texts
from pickwise.llm.words import (
    LOWER, SPACED, blocks, gram_hashes, hashes, mix, row_blocks, spans, utf8,
)
from pickwise.operators.skew import hot_keys, split_join
from pickwise.workspace import materialize

SHINGLE = 4
#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
COORDINATES, MATCHES = 32, 13
#: Shingles of the members of a posting that one block holds, about 16 MB of fingerprints.
BLOCK_SHINGLES = 1 << 21
_SEED = 0x51ED270B

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(_SEED)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text."""
    data, offsets = utf8(column)
    out: list[np.ndarray] = []
    for begin, end in blocks(offsets):
        part = LOWER[data[offsets[begin] : offsets[end]]]
        starts, ends, first = spans(part, offsets[begin : end + 1] - offsets[begin], SPACED)
        words = hashes(part, starts, ends)
        grams = gram_hashes(words, size)
        for a, b in zip(first.tolist(), first[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(grams[a : b - size + 1]))
            elif b > a:
                # A short text's one shingle; its length keeps it apart from all longer ones.
                out.append(mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart, whatever the order; None for the empty set."""
    if not len(shingles):
        return None
    sums = (shingles.sum(dtype=np.uint64), mix(shingles ^ np.uint64(_SEED)).sum(dtype=np.uint64))
    return b"".join(int(x).to_bytes(8, "big") for x in sums)


def signature(shingles: np.ndarray) -> np.ndarray:
    """One entry per coordinate: its number and the least value of the set there."""
    least = (shingles[None, :] * _FACTORS[:, None]).min(axis=1) >> np.uint64(32)
    return (np.arange(COORDINATES, dtype=np.int64) << 32) | least.astype(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``key`` of the set and its ``entries``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([set_key(x) for x in sets], pa.binary()),
                    pa.array([signature(x) if len(x) else None for x in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "key", "entries"],
            )

    schema = f"doc_id {kind}, n_shingles long, key binary, entries array<long>"
    return texts(docs).mapInArrow(run, schema)


def postings(classes: DataFrame) -> DataFrame:
    """``entry``, ``key``, ``n_shingles`` and ``weight`` of the posted prefixes.

    ``weight``, the number of classes met in all entries, is largest for the most central member.
    """
    entries = classes.select("key", "n_shingles", F.explode("entries").alias("entry"))
    counts = entries.groupBy("entry").agg(F.count("*").alias("rows")).filter("rows > 1")
    counts = materialize(counts, "entry-counts")
    shared = split_join(
        entries, counts.withColumnRenamed("entry", "__entry"), ["entry"], ["__entry"],
        hot=hot_keys(counts, ["entry"], "rows"),
    )
    # At most COORDINATES entries per class; those left out here are the rarest, met by nobody.
    posted = (
        shared.groupBy("key", "n_shingles")
        .agg(F.sort_array(F.collect_list(F.struct("rows", "entry"))).alias("found"), F.sum("rows").alias("weight"))
        .filter(F.size("found") >= MATCHES)
    )
    prefix = F.slice("found", 1, F.size("found") - (MATCHES - 1))
    return posted.select(
        "key", "n_shingles", "weight", F.explode(F.transform(prefix, lambda x: x["entry"])).alias("entry")
    )


def _blocked(posted: DataFrame) -> DataFrame:
    """The postings that are compared, in blocks: ``entry``, ``blocks``, ``block``, ``key``, ``central``."""
    facts = (
        posted.groupBy("entry")
        .agg(
            F.count("*").alias("members"),
            F.sum("n_shingles").alias("size"),
            F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"),
            F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(38,0)")).alias("sum2"),
            F.max(F.struct("weight", "key")).alias("best"),
        )
        .filter("members > 1")
    )
    # The same members under several entries are compared once.
    merged = facts.groupBy("members", "sum", "sum2").agg(
        F.min("entry").alias("entry"), F.first("size").alias("size"), F.max("best").alias("best")
    )
    count = F.greatest(F.ceil(F.col("size") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    kept = materialize(
        merged.select(F.col("entry").alias("__entry"), count.alias("blocks"), F.col("best.key").alias("best"), F.col("members").alias("rows")),
        "postings-kept",
    )
    hot = hot_keys(kept.select(F.col("__entry").alias("entry"), "rows"), ["entry"], "rows")
    members = split_join(posted, kept.drop("rows"), ["entry"], ["__entry"], hot=hot)
    block = F.pmod(F.xxhash64("key"), F.col("blocks").cast("long")).cast("int")
    placed = members.select("entry", "blocks", block.alias("block"), "key", F.lit(False).alias("central"))
    central = kept.select(
        F.col("__entry").alias("entry"), "blocks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("best").alias("key"), F.lit(True).alias("central"),
    )
    return placed.unionByName(central)


class _Sets:
    """Sets whose overlaps with one of them are counted all at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets])
        values, self.numbers = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.marked = np.zeros(len(values), bool)

    def linked(self, row: int) -> np.ndarray:
        """Flags of the sets that are similar enough to that of ``row``."""
        mine = self.numbers[self.starts[row] : self.starts[row] + self.sizes[row]]
        self.marked[mine] = True
        both = np.add.reduceat(self.marked[self.numbers].astype(np.int64), self.starts)
        self.marked[mine] = False
        return 100 * both >= PERCENT * (self.sizes + self.sizes[row] - both)


def local_links(sets: list[np.ndarray], queries: list[int], groups: np.ndarray) -> list[tuple[int, int]]:
    """Links (query, other) that join different ``groups``, enough to connect all that are linked."""
    table, groups, out = _Sets(sets), groups.copy(), []
    for row in queries:
        other = groups != groups[row]
        if not other.any():
            continue
        found = np.flatnonzero(table.linked(row) & other)
        if len(found):
            _, one_each = np.unique(groups[found], return_index=True)
            out += [(row, int(n)) for n in found[one_each]]
            groups[np.isin(groups, groups[found])] = groups[row]
    return out


LINKS = "a binary, b binary"


def _link_groups(members: DataFrame, by: list[str], queries: str) -> DataFrame:
    """Links inside each group of ``members`` (``key``, ``text``, ``group``) with equal ``by``.

    ``queries`` flags the rows that are compared with all others, the ``central`` one first. Rows of a
    group come together by a shuffle and a sort, and one group is in memory at a time.
    """

    def links_of(keys, columns, flags, known):
        order = sorted(range(len(keys)), key=lambda n: not flags[n][1])
        seen: dict[bytes, int] = {}
        for n in order:
            seen.setdefault(keys[n], n)
        rows = list(seen.values())
        if len(rows) < 2:
            return []
        sets = shingle_sets(pa.array([columns[n] for n in rows], pa.large_string()))
        names = {}
        groups = np.array(
            [names.setdefault(known[n] if known[n] is not None else keys[n], len(names)) for n in rows]
        )
        asked = [i for i, n in enumerate(rows) if flags[n][0]]
        return [(keys[rows[a]], keys[rows[b]]) for a, b in local_links(sets, asked, groups)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, ([], [], [], [])
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in by]
            rest = [batch.column(c).to_pylist() for c in ("key", "text", queries, "central", "group")]
            for group, key, text, asked, central, known in zip(zip(*columns), *rest):
                if group != current:
                    found += links_of(*rows)
                    current, rows = group, ([], [], [], [])
                for column, value in zip(rows, (key, text, (asked, central), known)):
                    column.append(value)
            if found:
                yield _links(found)
        if found := links_of(*rows):
            yield _links(found)

    return members.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, LINKS)


def _links(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key`` and one ``text`` for each of the ``wanted`` classes (``key``, ``doc_id``)."""
    rows = texts(docs).join(
        wanted.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")),
        F.col("doc_id").eqNullSafe(F.col("__id")),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "text"):
            keys = pa.array([set_key(x) for x in shingle_sets(batch.column("text"))], pa.binary())
            # Another text may have the same id.
            right = pa.array([a == b for a, b in zip(keys.to_pylist(), batch.column("__key").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([keys, batch.column("text")], ["key", "text"]).filter(right)

    found = rows.select("text", "__key").mapInArrow(run, "key binary, text string")
    return found.groupBy("key").agg(F.min("text").alias("text"))


def class_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between the keys of ``classes`` that connect all similar ones."""
    posted = materialize(postings(classes), "postings")
    placed = materialize(_blocked(posted), "blocks")
    wanted = classes.join(placed.select("key").distinct(), "key", "left_semi").select("key", "doc_id")
    stored = materialize(_class_texts(docs, wanted), "class-texts")
    members = placed.join(stored, "key").withColumns(
        {"asked": F.lit(True), "group": F.lit(None).cast("binary")}
    )
    links = materialize(_link_groups(members, ["entry", "block"], "asked"), "class-links")
    large = placed.filter((F.col("blocks") > 1) & ~F.col("central"))
    if large.isEmpty():
        return links
    # Second pass: members apart from the central one's group meet the other blocks of their posting.
    roots = components(links).select(F.col("node").alias("key"), F.col("root").alias("group"))
    grouped = large.join(roots, "key", "left").withColumn("group", F.coalesce("group", "key"))
    centre = placed.filter("blocks > 1 and central and block = 0").join(roots, "key", "left")
    centre = centre.select("entry", F.coalesce("group", "key").alias("centre"))
    apart = grouped.join(centre, "entry").filter(F.col("group") != F.col("centre"))
    apart = materialize(apart.select("entry", "blocks", "block", "key", "group"), "apart")
    others = apart.select("entry", F.col("block").alias("asking")).distinct()
    asked = apart.select(
        "entry", F.col("block").alias("asking"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key", "group",
        F.lit(True).alias("asked"),
    ).filter("asking <> block")
    answering = grouped.join(others, "entry").select(
        "entry", "asking", "block", "key", "group", F.lit(False).alias("asked")
    ).filter("asking <> block")
    meeting = asked.unionByName(answering).join(stored, "key").withColumn("central", F.lit(False))
    more = _link_groups(meeting, ["entry", "asking", "block"], "asked")
    return links.unionByName(materialize(more, "class-links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` per row of ``docs``."""
    rows = materialize(signed(docs), "signatures")
    classes = materialize(
        rows.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"), F.first("n_shingles").alias("n_shingles"), F.min("entries").alias("entries")),
        "classes",
    )
    roots = components(class_links(docs, classes))
    named = classes.select("key", "doc_id", "rows").join(roots.withColumnRenamed("node", "key"), "key", "left")
    linked = named.filter(F.col("root").isNotNull())
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    whole = linked.join(least, "root").select("key", "component_id")
    alone = named.filter(F.col("root").isNull()).select("key", F.col("doc_id").alias("component_id"))
    found = materialize(whole.unionByName(alone).withColumnRenamed("key", "__key"), "components")
    hot = hot_keys(classes.select("key", "rows"), ["key"], "rows")
    with_key = split_join(
        rows.filter(F.col("key").isNotNull()).drop("entries"), found, ["key"], ["__key"], hot=hot
    ).select("doc_id", "n_shingles", "component_id")
    without = rows.filter(F.col("key").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return with_key.unionByName(without).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, the one with the smallest id.

    Of repeated rows one stays. Texts without words are kept, and so are all columns, whatever their names.
    """
    kept = near_duplicates(docs).filter("kept").groupBy("doc_id").agg(F.count("*").alias("__rows"))
    kept = kept.withColumnRenamed("doc_id", "__id")
    plain = plain_names(docs, "doc_id", "text")
    marked = plain.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")))
    once = marked.filter("__rows = 1").select(*plain.columns)
    # The same id several times: repeated rows, or texts of different groups under one id.
    several = marked.filter("__rows > 1").select(*plain.columns).dropDuplicates(["doc_id", "text"])
    return once.unionByName(several).toDF(*docs.columns)
