"""Positions, splits, ranks and samples against brute force, with copies and hot keys."""

import hashlib
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pickwise.operators import metrics, ordering, ranking, sampling
from pickwise.operators.candidates import fm_scorer, score_topk
from pickwise.operators import candidates


@pytest.fixture(scope="module")
def table(spark):
    """600 rows, a third of them one user, a third of them identical."""
    rng = random.Random(3)
    data = [("hot", 7, 1)] * 200
    data += [("hot", rng.randrange(50), rng.randrange(9)) for _ in range(100)]
    data += [(f"u{rng.randrange(40)}", rng.randrange(50), rng.randrange(9)) for _ in range(300)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "user string, item int, day int").repartition(7)


def _md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def _numbered(data):
    seen = {}
    for row in data:
        seen[row] = seen.get(row, -1) + 1
        yield (*row, seen[row])


@pytest.mark.parametrize("chunk", [3, 100_000])
def test_hash_positions(table, monkeypatch, chunk):
    monkeypatch.setattr(ordering, "COPY_CHUNK", chunk)
    data, df = table
    ordered = sorted(_numbered(data), key=lambda r: _md5("seed", *r))
    expected = sorted(((*r[:3], i) for i, r in enumerate(ordered)), key=repr)
    assert rows(ordering.hash_positions(df, "seed")) == expected


@pytest.mark.parametrize("chunk", [3, 100_000])
def test_sorted_positions(table, monkeypatch, chunk):
    monkeypatch.setattr(ordering, "COPY_CHUNK", chunk)
    data, df = table
    ordered = sorted(data, key=lambda r: (r[2], r[0], r[1]))
    expected = sorted(((*r, i) for i, r in enumerate(ordered)), key=repr)
    assert rows(ordering.sorted_positions(df, ["day", "user"])) == expected


@pytest.mark.parametrize("small", [0, 100_000])
@pytest.mark.parametrize("fraction", [0.0, 0.13, 0.5, 0.8, 1.0])
def test_temporal_split(table, monkeypatch, small, fraction):
    monkeypatch.setattr(ordering, "SMALL_SORT", small)
    data, df = table
    ordered = sorted(data, key=lambda r: (r[2], r[0], r[1]))
    cut = int(fraction * len(data))
    expected = [(*r, "train" if i < cut else "validation") for i, r in enumerate(ordered)]
    assert rows(ordering.temporal_split(df, "day", fraction)) == sorted(expected, key=repr)
    assert rows(ordering.tail_fraction(df, "day", fraction)) == sorted(ordered[cut:], key=repr)


def test_split_with_nulls(spark):
    data = [(None, "a"), (None, None), (1, None), (1, "b"), (2, "a"), (2, "a"), (2, "a")]
    df = spark.createDataFrame(data, "day int, user string")
    for cut in range(len(data) + 1):
        ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        got = ordering.split_at(df, ["day", "user"], lambda n: cut, "head")
        expected = [(*r, i < cut) for i, r in enumerate(ordered)]
        assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_train_test_split(table, fraction):
    data, df = table
    size = math.ceil(fraction * len(data))
    ordered = sorted(data, key=lambda r: (_md5(42, *r), r))
    expected = [(*r, "validation" if i < size else "train") for i, r in enumerate(ordered)]
    assert rows(sampling.train_test_split(df, fraction)) == sorted(expected, key=repr)


@pytest.mark.parametrize("small", [100_000, 3])
@pytest.mark.parametrize(
    "data",
    [
        [("x", None)] * 10 + [(None, "x")] * 10,
        [("x|y", "z")] * 7 + [("x", "y|z")] * 13,
        [("a", "b")] * 15 + [(None, None)] * 5,
    ],
)
def test_split_of_rows_with_equal_keys(spark, monkeypatch, small, data):
    monkeypatch.setattr(sampling, "_SMALL", small)
    df = spark.createDataFrame(data, "a string, b string")
    for fraction in (0.0, 0.3, 0.6, 0.75, 1.0):
        got = sampling.train_test_split(df, fraction).collect()
        assert sorted(map(repr, [(r.a, r.b) for r in got])) == sorted(map(repr, data))
        assert sum(r.split == "validation" for r in got) == math.ceil(fraction * len(data))


def test_results_do_not_depend_on_partitions(table, partitions):
    _, df = table
    results = set()
    for n in (1, 4, 16):
        partitions(n)
        results.add(
            repr(
                (
                    rows(ordering.hash_positions(df, 1)),
                    rows(ordering.sorted_positions(df, ["item"])),
                    rows(sampling.minibatches(df, 16)),
                    rows(ranking.rank_rows(df, "user", "item")),
                    rows(sampling.train_test_split(df)),
                )
            )
        )
    assert len(results) == 1


def _rank(data, k=None):
    out = []
    for user, item, day in data:
        rank = 1 + sum(1 for u, i, _ in data if u == user and i > item)
        if k is None or rank <= k:
            out.append((user, item, day, rank))
    return sorted(out, key=repr)


def test_rank_rows(table):
    data, df = table
    assert rows(ranking.rank_rows(df, "user", "item")) == _rank(data)


@pytest.mark.parametrize("k", [1, 5])
def test_topk_with_ties(table, k):
    data, df = table
    assert rows(ranking.topk_with_ties(df, "user", "item", k)) == _rank(data, k)


def test_topk_with_ties_counts_copies(table):
    data, df = table
    counted = df.groupBy("user", "item", "day").agg(F.count("*").alias("copies"))
    got = ranking.topk_with_ties(counted, "user", "item", 5, copies="copies")
    assert rows(got.drop("copies").distinct()) == sorted(set(_rank(data, 5)), key=repr)


def test_topk_exact(table):
    data, df = table
    got = ranking.topk_exact(df, "user", "item", ["day"], 4)
    expected = []
    for user in {r[0] for r in data}:
        best = sorted((r for r in data if r[0] == user), key=lambda r: (-r[1], r[2]))[:4]
        expected += [(*r, i + 1) for i, r in enumerate(best)]
    assert rows(got) == sorted(expected, key=repr)


def test_null_keys_and_scores_are_ranked(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", None), ("a", 3.0)], "k string, s double")
    expected = sorted([(None, 1.0, 2), (None, 2.0, 1), ("a", None, 2), ("a", 3.0, 1)], key=repr)
    assert rows(ranking.rank_rows(df, "k", "s")) == expected
    assert rows(ranking.topk_with_ties(df, "k", "s", 5)) == expected


def test_repeated_requests(spark):
    """A user asking twice keeps ranks 1, 3 and 5: three items, two copies each."""
    ranked = spark.createDataFrame([("U1", i, i) for i in range(1, 7)], "user string, item int, rank int")
    repeats = spark.createDataFrame([("U1", 2)], "user string, repeats long")
    got = ranking.ranks_with_repeats(ranked, repeats, "user")
    assert sorted((r["item"], r["rank"], r["copies"]) for r in got.collect()) == [
        (1, 1, 2), (2, 3, 2), (3, 5, 2)
    ]


def test_recommendation_lists_are_ordered(spark):
    ranked = spark.createDataFrame(
        [("U", "c", 2), ("U", "a", 1), ("U", "b", 2), ("V", "z", 1)], "user_id string, asin string, rank int"
    )
    got = {r.user_id: r.top_k_asins for r in ranking.recommendation_lists(ranked).collect()}
    assert got == {"U": ["a", "b", "c"], "V": ["z"]}


# --- sampling ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    data = [("hot", "i1", "s1", 1)] * 100
    data += [
        (f"u{rng.randrange(30)}", f"i{rng.randrange(20)}", f"s{rng.randrange(3)}", rng.randrange(2))
        for _ in range(300)
    ]
    return data, spark.createDataFrame(data, "user_id string, parent_asin string, store string, label int")


@pytest.mark.parametrize("k", [1, 3])
def test_negatives(labelled, k):
    data, df = labelled
    got = [tuple(r) for r in sampling.negative_sampling(df, k=k).collect()]
    positives = [r for r in data if r[3] == 1]
    negatives = list(got)
    for row in data:
        negatives.remove(row)
    assert len(negatives) == k * len(positives)
    assert sorted(r[0] for r in negatives) == sorted(k * [r[0] for r in positives])
    assert sorted(r[1:3] for r in negatives) == sorted(k * [r[1:3] for r in positives])


def test_strict_negatives_are_no_positives(labelled):
    data, df = labelled
    positives = {r[:3] for r in data if r[3] == 1}
    got = [tuple(r) for r in sampling.negative_sampling(df, exclude_positives=True).collect()]
    extra = list(got)
    for row in data:
        extra.remove(row)
    assert extra and not [r for r in extra if r[:3] in positives]


def test_no_positive_gives_no_negatives(spark):
    df = spark.createDataFrame([("u", "i", "s", 0)], "user_id string, parent_asin string, store string, label int")
    assert rows(sampling.negative_sampling(df)) == [("u", "i", "s", 0)]


def test_minibatches(table):
    data, df = table
    got = sampling.minibatches(df, 16).collect()
    assert sorted(r.position for r in got) == list(range(len(data)))
    sizes = {}
    for r in got:
        sizes[r.batch] = sizes.get(r.batch, 0) + 1
    assert sorted(sizes) == list(range(38)) and [sizes[b] for b in range(37)] == [16] * 37
    other = sampling.minibatches(df, 16, epoch=1)
    assert rows(other) != rows(sampling.minibatches(df, 16))


def test_samples(spark, table):
    _, df = table
    users = spark.createDataFrame([(f"u{i}", i) for i in range(10)], "value string, idx int")
    drawn = sampling.sample_with_replacement(users, 50).collect()
    assert len(drawn) == 50 and len({r.value for r in drawn}) > 5
    assert sampling.sample_rows(df, 7).count() == 7
    assert rows(sampling.sample_rows(df, 7)) == rows(sampling.sample_rows(df.repartition(3), 7))


# --- metrics -----------------------------------------------------------------------------------


def test_roc_auc(spark):
    rng = random.Random(9)
    data = [(rng.randrange(20) / 4.0, int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(data, "score double, label int")
    wins = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for p, yes in data if yes for n, no in data if not no
    ]
    assert metrics.roc_auc(df, "score", "label").head()["roc_auc"] == pytest.approx(sum(wins) / len(wins))
    one_class = df.filter("label = 1")
    assert metrics.roc_auc(one_class, "score", "label").head()["roc_auc"] is None
    assert metrics.roc_auc(df.filter("1 = 0"), "score", "label").head()["roc_auc"] is None


def test_log_loss_of_large_logits(spark):
    df = spark.createDataFrame([(800.0, 1), (-800.0, 0), (800.0, 0), (0.0, 1)], "z double, y int")
    loss = metrics.mean_log_loss(df, "z", "y").head()["loss"]
    assert loss == pytest.approx((800.0 + math.log(2)) / 4)


# --- candidates --------------------------------------------------------------------------------


@pytest.mark.parametrize("block,exact", [(8192, False), (7, False), (7, True), (1, False)])
def test_block_scoring_equals_all_pairs(spark, monkeypatch, block, exact):
    rng = random.Random(1)
    monkeypatch.setattr(candidates, "BLOCK_ROWS", block)
    monkeypatch.setattr(candidates, "CHUNK_PAIRS", 20)
    users = [(u, [float(rng.randrange(-2, 3)) for _ in range(2)]) for u in range(9)]
    items = [(i, i % 3, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(31)]
    got = score_topk(
        spark.createDataFrame(users, "map_user_id int, user_vector array<float>"),
        spark.createDataFrame(items, "parent_asin int, store_id int, item_vector array<float>"),
        fm_scorer, 5, exact,
    )
    expected = []
    for u, uv in users:
        scored = []
        for i, s, iv in items:
            x = uv + iv
            scored.append((0.5 * (sum(x) ** 2 - sum(e * e for e in x)), i, s))
        if exact:
            best = sorted(scored, key=lambda r: (-r[0], r[1]))[:5]
            expected += [(u, i, s, v, n + 1) for n, (v, i, s) in enumerate(best)]
        else:
            for v, i, s in scored:
                rank = 1 + sum(1 for other in scored if other[0] > v)
                if rank <= 5:
                    expected.append((u, i, s, v, rank))
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("exact", [False, True])
def test_items_that_are_nobodys_best_are_not_scored(spark, monkeypatch, exact):
    """Many buckets, ties, copies and a NaN; the result is that of all pairs, which few items meet."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(candidates, "MIN_BLOCK_PAIRS", 1)
    monkeypatch.setattr(candidates, "PRUNE_ROWS", 500)
    users = [(u, rng.normal(size=8).round(2).tolist()) for u in range(60)]
    items = [(i, i % 7, rng.normal(size=16).round(1).tolist()) for i in range(2000)]
    items += [(i + 2000, s, v) for i, s, v in items[:400]] + [(9000, 1, [math.nan] * 16)]
    users = spark.createDataFrame(users, "map_user_id int, user_vector array<float>")
    items = spark.createDataFrame(items, "parent_asin int, store_id int, item_vector array<float>")
    left = candidates.prune_items(users, items, fm_scorer, 5)
    assert 5 < left.count() < 500 and left.filter("parent_asin = 9000").count() == 1
    got = score_topk(users, items, fm_scorer, 5, exact)
    plain = score_topk(users, items, lambda matrix: fm_scorer(matrix), 5, exact)
    assert rows(got) == rows(plain) and got.count() >= 300


def test_pruning_keeps_all_items_that_may_be_best(spark, monkeypatch):
    """Items of which each is somebody's best, equal items, and no users that can be placed."""
    monkeypatch.setattr(candidates, "MIN_BLOCK_PAIRS", 1)
    layout = "parent_asin int, store_id int, item_vector array<float>"
    users = spark.createDataFrame(
        [(u, [float(u - 20), 0.0]) for u in range(41)], "map_user_id int, user_vector array<float>"
    )
    tangents = spark.createDataFrame(
        [(i, 0, [float(i - 20), -(i - 20) / 2.0]) for i in range(41)], layout
    )
    best = candidates.score_topk(users, tangents, lambda m: fm_scorer(m), 1)
    named = {r.parent_asin for r in best.collect()}
    kept = {r.parent_asin for r in candidates.prune_items(users, tangents, fm_scorer, 1).collect()}
    assert named <= kept
    equal = spark.createDataFrame([(i, 0, [1.0, 2.0]) for i in range(50)], layout)
    assert candidates.prune_items(users, equal, fm_scorer, 3).count() == 50
    odd = spark.createDataFrame([(1, [math.nan, 0.0])], "map_user_id int, user_vector array<float>")
    assert candidates.prune_items(odd, tangents, fm_scorer, 1).count() == 41


def test_network_items_that_are_nobodys_best_are_not_scored(spark, monkeypatch):
    """Bounds on what the layers add leave out items too; the rows are those of all pairs."""
    from pickwise.models.network import Network

    rng = np.random.default_rng(4)
    monkeypatch.setattr(candidates, "MIN_BLOCK_PAIRS", 1)
    monkeypatch.setattr(candidates, "PRUNE_ROWS", 700)
    users = [(u, rng.normal(size=8).round(2).tolist()) for u in range(50)]
    items = [(i, i % 7, rng.normal(size=16).round(1).tolist()) for i in range(2000)]
    users = spark.createDataFrame(users, "map_user_id int, user_vector array<float>")
    items = spark.createDataFrame(items, "parent_asin int, store_id int, item_vector array<float>")
    scorer = Network.start(24, (5, 4), 2).pair_scorer()
    left = candidates.prune_items(users, items, scorer, 4)
    assert 4 < left.count() < 1000
    assert rows(score_topk(users, items, scorer, 4)) == rows(score_topk(users, items, lambda m: scorer(m), 4))


def test_block_counts():
    assert candidates.block_counts(1, 1, 8) == (1, 1)
    assert candidates.block_counts(10, 10, 1000) == (1, 1)
    users, items = candidates.block_counts(10_000_000, 3_000_000, 4000)
    assert users == math.ceil(10_000_000 / 8192) and items == math.ceil(3_000_000 / 8192)
    users, items = candidates.block_counts(15_000, 18_000, 8)
    assert users * items >= 32
