import hashlib
import random
import re

import numpy as np
import pytest
from edge import LONG, ROWS, docs, empty

from pickwise.llm import substrings
from pickwise.llm.fm_index import FMIndex, WaveletTree
from pickwise.llm.queries import op10_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(given, window=20):
    """The definition: the earliest place of every window."""
    place = lambda doc_id: float("inf") if doc_id is None else doc_id
    words = [WORD.findall(text or "") for _, text in given]
    first = {}
    for (doc_id, _), w in zip(given, words):
        for at in range(len(w) - window + 1):
            key, here = tuple(w[at : at + window]), (place(doc_id), at)
            first[key] = min(first.get(key, here), here)
    out = []
    for (doc_id, _), w in zip(given, words):
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < (place(doc_id), at):
                gone.update(range(at, at + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def corpus(seed, n=120):
    """Copies, shared passages of all lengths, repeats inside a text, short loops of words."""
    rng = random.Random(seed)
    fresh = lambda k: [f"w{rng.randint(0, 10**6)}" for _ in range(k)]
    passages = [fresh(rng.choice([15, 19, 20, 21, 25, 60, 150])) for _ in range(8)]
    out = []
    for doc_id in rng.sample(range(1000), n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.4:
                words += fresh(rng.randint(1, 60))
            elif kind < 0.8:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 3)
                words += p[a : rng.randint(2 * len(p) // 3, len(p))]
            else:
                words += (fresh(rng.choice([1, 2, 7])) * 40)[: rng.randint(10, 70)]
        out.append((doc_id, " ".join(words)))
        if rng.random() < 0.15:
            out.append((rng.randint(1001, 2000), out[rng.randrange(len(out))][1]))
    return out


@pytest.mark.parametrize("hot, shard_bytes", [(1 << 20, 16 << 20), (1, 2000)])
def test_by_definition(spark, monkeypatch, hot, shard_bytes):
    """Also with many shards and every shared anchor taken as hot."""
    monkeypatch.setattr(substrings, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard_bytes)
    given = corpus(1) + [(5000, "x " * 300), (5001, "x " * 100 + "y"), (5002, "a b " * 60)]
    # Tests run with few rows per task, too.
    assert found(substrings.digests(docs(spark, given).repartition(6))) == brute(given)


def test_same_id_with_different_texts(spark):
    p = " ".join(f"p{n}" for n in range(30))
    given = [(7, p + " one"), (7, p + " two"), (7, "zero " + p), (8, p), (8, p), (None, p), (None, p + " q")]
    assert found(substrings.digests(docs(spark, given))) == brute(given)


def test_edge_rows(spark):
    rows = [r for r in ROWS if r[1] != LONG] + [(5, LONG[:40_000]), (5, LONG[:40_000]), (9, "Ä b\x85c d " * 30)]
    assert found(substrings.digests(docs(spark, rows))) == brute(rows)
    assert substrings.digests(empty(spark)).count() == 0
    kept = {r.doc_id: r.kept for r in substrings.remove_repeats(docs(spark, [(1, "a  b\n c"), (2, None)])).collect()}
    assert kept == {1: "a b c", 2: ""}


def test_long_text(spark):
    assert found(substrings.digests(docs(spark, [(5, LONG), (6, "new " + LONG)]))) == brute([(5, LONG), (6, "new " + LONG)])


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 300):
        symbols = rng.integers(0, size, 500)
        tree = WaveletTree(symbols, size)
        at = rng.integers(0, 501, 200)
        asked = rng.choice(symbols, 200)
        expected = [(symbols[:n] == s).sum() for s, n in zip(asked, at)]
        assert tree.rank(asked, at).tolist() == expected


def test_fm_index():
    rng = np.random.default_rng(2)
    lengths = rng.integers(6, 15, 60)
    words = rng.integers(1, 4, int(lengths.sum()))
    index = FMIndex(words, lengths, 6)
    starts = np.concatenate([np.arange(f, f + n - 5) for f, n in zip(index.first, lengths)])
    low, high = index.search(starts, 6)
    windows = [tuple(index.text[s : s + 6]) for s in starts]
    for s, w, a, b in zip(starts, windows, low, high):
        count = windows.count(w)
        assert b - a == (count if count > 1 else 0)
        if count > 1:
            assert sorted(index.order[a:b]) == sorted(x for x, y in zip(starts, windows) if y == w)


def test_query_by_definition(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op10_substrings(spark, sf_dir)
    assert found(got) == brute(given)
