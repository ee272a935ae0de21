"""Spelling variants: words that differ by one letter, grouped under their most frequent form.

Words are counted in tasks and summed by word. A word and any word near it (one code point inserted, deleted
or replaced) share the word's left half at the beginning or its right half at the end. So every word goes as
an indexed word to the shards of the halves that words near it can have, four at most, and as a pattern to
the shards of its own two halves. A shard holds a bounded part of the vocabulary in a bidirectional FM-index
(``word_index``) and searches its patterns there: one half exactly, across the other with one error. Pairs
never leave a shard: it returns the number of near words and the best of them for each pattern.

A half that more words share than a shard should hold is split: its words are dealt to blocks with a shard
of their own, and its patterns visit all of them.

* Null texts hold no words; a null id counts as an empty string. Rows with equal ids and texts count as often
  as they stand there. An empty table gives an empty one. Other columns are ignored.
* Very long texts are read run by run, and words of any length are searched like others.
* Of near words with equal counts the first in code-point order is the form.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.tables import texts
from pickwise.llm.word_index import Patterns, WordIndex, mirrored
from pickwise.llm.words import row_blocks
from pickwise.workspace import materialize, scratch_scope

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A word has this many code points and this many occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One in so many runs loses a code point.
DAMAGED = 97
#: Texts longer than this are read run by run.
LONG_TEXT = 1 << 20
#: Different words that a task holds before it passes their counts on.
COUNTED = 1 << 18
#: Symbols of indexed words that a shard holds, about.
SHARD_SYMBOLS = 1 << 19
#: Words with a half in common from which that half is split, and the part of all rows that sets the limit
#: if it is more: at most ``HALVES`` halves can exceed it, so that these fit a broadcast.
HOT_WORDS, HALVES = 1 << 15, 1 << 12


def as_read(doc_id: str, run: str) -> str:
    """A run in lower case; for one in 97 pairs of document and run, without one of its letters."""
    low = run.lower() if run.isascii() else run.encode().lower().decode()
    h = zlib.crc32(f"{doc_id}:{low}".encode())
    if h % DAMAGED:
        return low
    cut = h % len(low)
    return low[:cut] + low[cut + 1 :]


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words, before the least count is applied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in row_blocks(batches, "text"):
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                if not text:
                    continue
                if len(text) > LONG_TEXT:
                    runs = Counter(found[0] for found in _RUN.finditer(text))
                else:
                    runs = Counter(_RUN.findall(text))
                for form, n in runs.items():
                    if len(form) >= LEAST_LENGTH:
                        word = as_read(doc_id, form)
                        if len(word) >= LEAST_LENGTH:
                            counts[word] += n
            if len(counts) > COUNTED:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    named = texts(docs).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
    )


def routes(words: DataFrame) -> DataFrame:
    """``half, word, n, asks``: the halves under which a word is found, and whether it asks there itself.

    A pattern of length L has a left half of L div 2 code points; a word near it is as long or by one
    longer or shorter.
    """
    size = F.char_length("word")

    def halves(side: str, length, cut) -> Column:
        lengths = F.array_distinct(F.array(*[length(size + k) for k in (-1, 0, 1)]))
        return F.transform(
            lengths,
            lambda k: F.struct(F.concat(F.lit(side), cut(k)).alias("half"), (k == length(size)).alias("asks")),
        )

    left = halves("<", lambda n: F.floor(n / 2).cast("int"), lambda k: F.substring("word", F.lit(1), k))
    right = halves(">", lambda n: F.ceil(n / 2).cast("int"), lambda k: F.substring("word", size - k + 1, k))
    return words.select(F.explode(F.concat(left, right)).alias("route"), "word", "n").select(
        "route.half", "word", "n", "route.asks"
    )


def in_shards(routed: DataFrame, symbols: int, rows: int) -> DataFrame:
    """``shard, word, n, side, held, asks``: every word of a shard once per side and role.

    Halves share shards by a hash; split halves have shards of their own.
    """
    spark = routed.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-symbols // SHARD_SYMBOLS))
    most = max(HOT_WORDS, rows // HALVES)
    hot = (
        routed.groupBy("half").agg(F.count("*").alias("words")).filter(F.col("words") > most)
        .select("half", F.ceil(F.col("words") / most).cast("long").alias("blocks"))
    )
    placed = routed.join(F.broadcast(hot), "half", "left")
    one = F.struct(
        F.pmod(F.xxhash64("half"), F.lit(shards)).cast("string").alias("shard"), F.lit(True).alias("held")
    )
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    block = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    visits = F.filter(block, lambda k: F.col("asks") | (k == own))
    many = F.transform(
        visits, lambda k: F.struct(F.concat_ws("#", "half", k.cast("string")).alias("shard"), (k == own).alias("held"))
    )
    return placed.select(
        F.explode(F.when(F.col("blocks").isNull(), F.array(one)).otherwise(many)).alias("at"),
        "word", "n", F.substring("half", 1, 1).alias("side"), "asks",
    ).select("at.shard", "word", "n", "side", "at.held", "asks")


_NEAREST = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())]
)


def search_shard(rows: pa.Table) -> pa.Table:
    """Near words of the patterns of one shard: their number and the best, for each pattern and side."""
    word, side = rows.column("word").to_pylist(), rows.column("side").to_pylist()
    held, asks = (rows.column(c).to_numpy() for c in ("held", "asks"))
    counts = rows.column("n").to_numpy()
    n_of = {word[k]: int(counts[k]) for k in np.flatnonzero(held)}
    index_words = sorted(n_of)
    n = np.array([n_of[w] for w in index_words], np.int64)
    letters = sorted(set("".join(word)))
    bits = len(letters).bit_length()
    code = np.zeros(256, np.int64)
    code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)

    def coded(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return code[np.frombuffer("".join(some).encode("latin-1"), np.uint8)], np.array(
            [len(w) for w in some], np.int64
        )

    index = WordIndex(*coded(index_words), bits) if index_words else None
    out = []
    for of, backwards in (("<", False), (">", True)):
        asking = [k for k in np.flatnonzero(asks) if side[k] == of]
        patterns = [word[k] for k in asking]
        total, best = np.zeros(len(patterns), np.int64), np.full(len(patterns), -1)
        if index is not None and patterns:
            symbols, lengths = coded(patterns)
            left = lengths // 2
            forward = Patterns(symbols, lengths)
            if backwards:
                searched = Patterns(mirrored(symbols, lengths), lengths)
                pattern, near = index.near(searched, lengths - left, True)
                new = ~_share_head(index, forward, left, pattern, near)  # the left half has found the others
                pattern, near = pattern[new], near[new]
            else:
                pattern, near = index.near(forward, left, False)
            total = np.bincount(pattern, minlength=len(patterns))
            order = np.lexsort((near, -n[near], pattern))
            firsts, begin = np.unique(pattern[order], return_index=True)
            best[firsts] = near[order][begin]
        known = best >= 0
        out.append(
            pa.table(
                [
                    pa.array(patterns, pa.string()),
                    pa.array(counts[asking], pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(n[best] if len(n) else best, pa.int64(), mask=~known),
                    pa.array([index_words[k] if k >= 0 else None for k in best], pa.string()),
                ],
                schema=_NEAREST,
            )
        )
    return pa.concat_tables(out)


def _share_head(index: WordIndex, patterns: Patterns, heads, pattern, near) -> np.ndarray:
    """Whether the word of each pair begins with the pattern's head."""
    lengths = np.diff(np.append(index.starts, len(index.symbols)))
    out = lengths[near] >= heads[pattern]
    live, place = np.flatnonzero(out), 0
    while len(live):
        live = live[heads[pattern[live]] > place]
        p, w = pattern[live], near[live]
        equal = patterns.flat[patterns.starts[p] + place] == index.symbols[index.starts[w] + place]
        out[live[~equal]] = False
        live, place = live[equal], place + 1
    return out


def nearest(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n`` for a table of distinct ``word, n``."""
    size = words.agg(F.sum(F.char_length("word") + 1), F.count("*")).head()
    routed = routes(words)
    placed = in_shards(routed, 4 * (size[0] or 0), 4 * size[1])
    found = placed.groupBy("shard").applyInArrow(
        search_shard, "word string, n long, n_near long, near_n long, near string"
    )
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near"))))
    each = found.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    )
    form_n = -F.col("best.less")
    larger = form_n >= 2 * F.col("n")
    return each.select(
        "word", "n", "n_near",
        F.when(larger, F.col("best.near")).alias("form"), F.when(larger, form_n).alias("form_n"),
    )


def add_roots(forms: DataFrame, largest: int) -> DataFrame:
    """``root`` for rows of ``word, form``: the end of the chain of forms.

    Counts at least double from a word to its form, so chains are at most log2(largest) long, and pointers
    that double their reach get to the ends in a few rounds. Words at their end are joined no more.
    """
    links = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(False).alias("ended"))
    rounds = math.ceil(math.log2(max(2, math.log2(max(2, largest))))) + 1
    for _ in range(rounds):
        further = links.select(
            F.col("word").alias("root"), F.col("root").alias("next"), F.col("ended").alias("next_ended")
        )
        moved = links.filter("NOT ended").join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.coalesce("next_ended", F.lit(True)).alias("ended")
        )
        links = materialize(moved.union(links.filter("ended")), "links")
    return forms.join(links.select("word", "root"), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the table; computed at once."""
    spark = docs.sparkSession
    with scratch_scope(spark) as keep:
        words = materialize(count_words(docs).filter(F.col("n") >= LEAST_COUNT), "words")
        forms = materialize(nearest(words), "forms")
        largest = forms.agg(F.max("n")).head()[0] or 1
        result = materialize(
            add_roots(forms, largest).select("word", "form", "root", "n", "n_near", "form_n"), "variants"
        )
        keep(result)
    return result
