import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import LONG, ROWS, docs, empty

from pickwise.llm import spelling, word_index
from pickwise.llm.queries import op13_spelling


def near_words(word, vocabulary, letters):
    """Words at distance one, by trying every change."""
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in letters}
    return (out & vocabulary) - {word}


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def grouped(counts):
    letters, vocabulary, forms, out = set("".join(counts)), set(counts), {}, {}
    for word, n in counts.items():
        near = near_words(word, vocabulary, letters)
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 2 * n else None
        out[word] = len(near)
    result = []
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        result.append((word, form, root, n, out[word], counts[form] if form else None))
    return sorted(result, key=repr)


def plain(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_brute_force(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = grouped(counted(map(tuple, given)))
    assert plain(op13_spelling(spark, sf_dir)) == want
    assert any(row[1] for row in want) and any(row[4] > 1 for row in want)


def test_edge_rows(spark):
    rows = [*ROWS, (8, "naïve naïve naïve naive naive naive x-naives naives naives"), (9, "a" * 3000 + " ") ] + [
        (10, ("a" * 3000 + " ") * 3 + ("a" * 2999 + "b ") * 9)
    ]
    assert plain(spelling.group_variants(docs(spark, rows))) == grouped(counted(rows))
    assert plain(spelling.group_variants(empty(spark))) == []


def test_long_text_is_read_whole(spark, monkeypatch):
    rows = [(1, LONG), (2, LONG.replace("quick", "quicks") * 2)]
    want = grouped(counted(rows))
    assert max(len(t) for _, t in rows) > spelling.LONG_TEXT
    monkeypatch.setattr(spelling, "COUNTED", 2)  # counts are passed on again and again
    assert plain(spelling.group_variants(docs(spark, rows))) == want


def test_chain_of_forms_and_ties(spark):
    rows = [(1, "aaaaab " * 4 + "aaaabb " * 8 + "aaabbb " * 16 + "aabbbb " * 32 + "abbbbb " * 64 + "bbbbbb " * 200)]
    rows += [(2, "ccccca " * 10 + "cccccb " * 10 + "cccccd " * 5)]
    # No run of these documents is one of the 97.
    assert plain(spelling.group_variants(docs(spark, rows))) == grouped(counted(rows))
    got = {r.word: r for r in spelling.group_variants(docs(spark, rows)).collect()}
    assert got["aaaaab"].root == "bbbbbb" and got["cccccd"].form == "ccccca"


@pytest.mark.parametrize("split", [False, True])
def test_random_vocabularies(spark, monkeypatch, split):
    """Few letters, many near words; with ``split``, every common half has several shards."""
    if split:
        monkeypatch.setattr(spelling, "HOT_WORDS", 5)
        monkeypatch.setattr(spelling, "SHARD_SYMBOLS", 200)
        monkeypatch.setattr(spelling, "HALVES", 1 << 30)
    rng = random.Random(4)
    counts = {}
    for _ in range(700):
        counts["".join(rng.choice("abÿ") for _ in range(rng.randint(5, 9)))] = rng.choice([3, 4, 6, 12, 40])
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.nearest(table).collect()
    want = [(w, n, near, form, form_n) for w, form, _, n, near, form_n in grouped(counts)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    with_roots = spelling.add_roots(spelling.nearest(table), max(counts.values()))
    got = with_roots.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=repr) == grouped(counts)


def test_suffixes_in_order():
    rng = np.random.default_rng(2)
    for bits in (2, 7, 31):
        text = np.concatenate([rng.integers(1, 4, 300), [0]])
        want = sorted(range(len(text)), key=lambda k: text[k:].tolist())
        assert word_index.suffix_order(text, len(text), bits).tolist() == want


def test_ranges_of_both_directions_agree():
    """A half matched to the left leaves the range that the other index has for it."""
    words = ["abcab", "abcaa", "babca", "cabca"]
    lengths = np.array([len(w) for w in words])
    symbols = np.array([ord(c) - 96 for w in words for c in w])
    index = word_index.WordIndex(symbols, lengths, 2)
    patterns = word_index.Patterns(symbols, lengths)
    at = np.arange(4)
    for heads in (1, 2, 3, 5):
        low, high = index._exact(patterns, at, np.full(4, heads), False)
        begins = [sum(v.startswith(w[:heads]) for v in words) for w in words]
        assert (high - low).tolist() == begins
        text = np.insert(symbols, np.concatenate([[0], np.cumsum(lengths)]), 0)[::-1]
        for w, a, b in zip(words, low, high):
            mirror = [ord(c) - 96 for c in reversed(w[:heads])] + [0]
            for k in index.sides[1].order[a:b]:
                assert text[k : k + heads + 1].tolist() == mirror
