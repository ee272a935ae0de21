"""Hot keys: same results with and without their own path, and the path is taken."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pickwise.models.embeddings import HotRows, embedding_lookup, normal_embeddings
from pickwise.operators import ranking, relational, skew, vocabulary
from pickwise.plans import jobs
from pickwise.schemas import ITEM_MAP, METADATA, RATINGS, STORE_MAP, USER_MAP
from pickwise.workspace import materialize


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(1, 5.0, "hot", "P1")] * 300
    data += [(n, 4.0, None, f"P{n % 9}") for n in range(150)]
    data += [(n, float(n % 5), f"U{n % 40}", f"P{n % 9}") for n in range(300)]
    data += [(n, 1.0, "U1", None) for n in range(20)]
    return spark.createDataFrame(data, RATINGS)


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame([(f"P{i}", f"S{i % 3}") for i in range(8)] + [("P1", "S9")], METADATA)


@pytest.fixture
def low_limit(monkeypatch):
    return lambda on: monkeypatch.setattr(skew, "HOT_ROWS", 50 if on else 10**9)


def test_hot_keys(ratings, low_limit, partitions):
    partitions(4)
    counts = ratings.groupBy("user_id").agg(F.count("*").alias("n"))
    low_limit(False)
    assert skew.hot_keys(counts, ["user_id"], "n") is None
    low_limit(True)
    assert rows(skew.hot_keys(counts, ["user_id"], "n")) == [("hot",)]
    partitions(8)
    assert rows(skew.hot_keys(counts, ["user_id"], "n")) == [("hot",), (None,)]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_join(spark, ratings, how, null_safe):
    lookup = spark.createDataFrame([("hot", 1), ("U1", 2), (None, 3)], "value string, idx int")
    hot = spark.createDataFrame([("hot",), (None,)], "user_id string")
    args = (ratings, lookup, ["user_id"], ["value"], how)
    expected = rows(skew.split_join(*args, null_safe=null_safe))
    assert rows(skew.split_join(*args, hot=hot, null_safe=null_safe)) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_right_side_is_copied_to_salts(spark, monkeypatch, partitions, how):
    """The rows for hot keys are not broadcast above the limit, and the result stays the same."""
    partitions(5)
    left = spark.createDataFrame([("a", n) for n in range(60)] + [("b", 1), ("z", 2)], "k string, n int")
    right = spark.createDataFrame([("a", f"x{n}") for n in range(6)] + [("b", "y")], "r string, v string")
    hot = spark.createDataFrame([("a",)], "k string")
    expected = rows(skew.split_join(left, right, ["k"], ["r"], how))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    assert rows(skew.split_join(left, right, ["k"], ["r"], how, hot=hot)) == expected


def test_jobs_give_the_same_with_hot_keys(spark, ratings, metadata, low_limit, partitions):
    partitions(16)
    found = []
    for on in (False, True):
        low_limit(on)
        dataset, maps = jobs.prepare(ratings, metadata)
        ranked = ranking.rank_rows(ratings, "user_id", "rating")
        best = ranking.topk_with_ties(ratings, "user_id", "rating", 3)
        often = relational.filter_low_occurrence(ratings, "user_id", 8)
        found.append([rows(df) for df in (dataset, maps, ranked, best, often)])
        plan = dataset._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftSemi" in plan) == on
    assert found[0] == found[1]


def test_vectors_are_the_same_with_hot_rows(spark, low_limit, partitions):
    partitions(16)
    maps = spark.createDataFrame(
        [(USER_MAP, "u", i) for i in range(5)] + [(ITEM_MAP, "i", i) for i in range(4)]
        + [(STORE_MAP, "s", 0)],
        "feature string, value string, idx int",
    )
    data = [(0, 1, 0)] * 100 + [(n % 5, n % 4, 0) for n in range(60)]
    df = spark.createDataFrame(data, "user_id int, parent_asin int, store int")
    vectors = normal_embeddings(maps, 2)
    expected = rows(embedding_lookup(df, vectors))
    low_limit(True)
    hot = HotRows.of(df)
    assert rows(hot.users) == [(0,)] and rows(hot.pairs) == [(1, 0)]
    assert rows(embedding_lookup(df, vectors, hot=hot)) == expected


def test_adaptive_execution_splits_large_partitions(spark, partitions):
    """Joins without counts rely on adaptive skew handling: a hot key is cut into several tasks."""
    partitions(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("k"),
            F.md5(F.concat(F.lit("x"), F.col("id"))).alias("payload"),
        )
        values = left.select(F.col("k").alias("value")).distinct()
        lookup = materialize(values.select("value", F.abs(F.hash("value")).alias("idx")), "lookup")
        joined = vocabulary.encode(left, "k", lookup, "null", output="id")
        counted = joined.agg(F.count("*"), F.sum("id"), F.max("payload"))
        assert counted.collect()[0][0] == 60_000
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
