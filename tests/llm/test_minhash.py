import random
import re
from collections import defaultdict

import numpy as np
import pytest
from edge import ROWS, docs, empty

from pickwise.llm import minhash
from pickwise.llm.components import components
from pickwise.llm.queries import op4_minhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[a : a + 4]) for a in range(len(words) - 3)}


def brute(given):
    """Every pair of rows compared on full sets."""
    sets = [shingles(t) for _, t in given]
    parent = list(range(len(given)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    posted = defaultdict(list)
    for n, found in enumerate(sets):
        for x in found:
            posted[x].append(n)
    shared = defaultdict(int)
    for rows in posted.values():
        for i, a in enumerate(rows):
            for b in rows[:i]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for n, (doc_id, _) in enumerate(given):
        if doc_id is not None:
            least[root(n)] = min(least.get(root(n), doc_id), doc_id)
    return sorted(
        repr((doc_id, len(sets[n]), least.get(root(n)), doc_id == least.get(root(n))))
        for n, (doc_id, _) in enumerate(given)
    )


def found(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def mutated(rng, words, share):
    return " ".join(rng.choice(["new", "other", "words"]) + str(rng.randint(0, 999)) if rng.random() < share else w for w in words)


def corpus(seed, groups=12, size=14):
    """Groups of copies, some as far apart as the threshold, with a passage that all groups share."""
    rng = random.Random(seed)
    shared = [f"s{n}" for n in range(30)]
    out = []
    for _ in range(groups):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 200))] + shared * rng.randint(0, 2)
        for _ in range(size):
            out.append(mutated(rng, words, rng.choice([0, 0.004, 0.01, 0.02, 0.04, 0.06])))
    order = list(range(len(out)))
    rng.shuffle(order)
    return [(n * 3, out[i]) for n, i in enumerate(order)]


@pytest.mark.parametrize("block", [minhash.BLOCK_SHINGLES, 500])
def test_groups_by_brute_force(spark, monkeypatch, block):
    """Also with postings cut into blocks of two or three members."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    given = corpus(3) + [(-5, "one two"), (-4, "One TWO"), (-3, "one two three"), (9000, None), (9001, " ")]
    assert found(minhash.near_duplicates(docs(spark, given))) == brute(given)


def test_edge_rows(spark):
    assert found(minhash.near_duplicates(docs(spark, ROWS))) == brute(ROWS)
    assert minhash.near_duplicates(empty(spark)).count() == 0
    kept = minhash.deduplicate(docs(spark, ROWS))
    assert kept.columns == docs(spark, ROWS).columns
    ids = sorted(repr(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "6", "None", "None"])


def test_pairs_that_agree_on_few_coordinates(spark):
    """Pairs at the similarity of 0.8 whose signatures agree on 15 of 32 coordinates."""
    given = []
    for n in (98578, 126252, 163974):
        words = [f"q{n}x{k}" for k in range(8)]
        given += [(n, " ".join(words[:7])), (n + 1, " ".join(words))]
    assert found(minhash.near_duplicates(docs(spark, given))) == brute(given)


def test_local_links_connect_what_is_linked():
    rng = random.Random(2)
    base = np.arange(100, dtype=np.uint64)
    sets = []
    for n in range(40):
        extra = np.array([1000 * n + k for k in range(rng.randint(0, 30))], np.uint64)
        sets.append(np.unique(np.concatenate([base[rng.randint(0, 15) :], extra])))
    links = minhash.local_links(sets, list(range(40)), np.arange(40))
    assert len(links) < 40
    groups = list(range(40))
    expected = list(range(40))
    for a in range(40):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                expected = [expected[b] if x == expected[a] else x for x in expected]
    for a, b in links:
        groups = [groups[b] if x == groups[a] else x for x in groups]
    canon = lambda g: [g.index(x) for x in g]
    assert canon(groups) == canon(expected)


def test_components(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{n: 0 for n in range(41)}, 100: 90, 90: 90, 95: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_by_brute_force(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op4_minhash(spark, sf_dir)
    assert found(got) == brute(given)
    assert got.filter("not kept").count() > 0
