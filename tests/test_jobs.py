"""Whole jobs, streams, restarts and replays."""

import pytest
from pyspark.errors import AnalysisException
from conftest import rows
from pyspark.sql import functions as F

from pickwise.operators.candidates import fm_scorer
from pickwise.operators.relational import union_all
from pickwise.operators.vocabulary import build_vocabulary
from pickwise.models.registry import ModelRegistry
from pickwise.plans import jobs
from pickwise.schemas import (
    ACTION_MESSAGE,
    ITEM_MAP,
    METADATA,
    RATINGS,
    REQUEST_MESSAGE,
    STORE_MAP,
    USER_MAP,
)
from pickwise.sources import files, streams, tables
from pickwise.sources.testdata import digit_vectors
from pickwise.streaming.jobs import each_batch, stream_recommendations, stream_retraining
from pickwise.workspace import scratch_path


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(n, float(1 + n % 5), f"U{n * 7 % 13}", f"P{n * 11 % 17}") for n in range(400)]
    data += [(1000, 5.0, None, "P1"), (1001, 5.0, "U1", "P99"), (1002, 5.0, "U1", None)]
    return spark.createDataFrame(data, RATINGS)


@pytest.fixture(scope="module")
def metadata(spark):
    data = [(f"P{i}", None if i == 4 else f"S{i % 3}") for i in range(17)] + [("P7", "S1"), ("P50", "S9")]
    return spark.createDataFrame(data, METADATA)


@pytest.fixture(scope="module")
def maps(ratings, metadata):
    joined = ratings.join(metadata, "parent_asin").dropna(subset=["store"])
    return union_all(
        build_vocabulary(joined, "user_id", USER_MAP),
        build_vocabulary(joined, "parent_asin", ITEM_MAP),
        build_vocabulary(joined, "store", STORE_MAP),
    )


def test_prepare_equals_join_then_encode(spark, ratings, metadata, maps):
    dataset, found = jobs.prepare(ratings, metadata)
    assert rows(found) == rows(maps)
    values = {(r.feature, r.idx): r.value for r in maps.collect()}
    decoded = [
        (values[ITEM_MAP, r.parent_asin], r.timestamp, r.rating, values[USER_MAP, r.user_id], values[STORE_MAP, r.store])
        for r in dataset.collect()
    ]
    joined = ratings.join(metadata, "parent_asin").dropna(subset=["store"])
    assert sorted(decoded, key=repr) == rows(
        joined.select("parent_asin", "timestamp", "rating", "user_id", "store")
    )


def _recommend(metadata, maps, **options):
    vectors = digit_vectors(maps)
    items = jobs.candidate_items(metadata, maps, vectors)
    return lambda requests: jobs.recommend(requests, items, maps, vectors, fm_scorer, **options)


def test_recommend_routes_unknown_users(spark, metadata, maps):
    requests = spark.createDataFrame([("U1",), ("U1",), ("ZZ",), ("U2",)], "user_id string")
    result = _recommend(metadata, maps, exact=True)(requests)
    lists = {r.user_id: r.top_k_asins for r in result.lists.collect()}
    assert set(lists) == {"U1", "U2"} and all(len(v) == 5 for v in lists.values())
    assert rows(result.unknown_users) == [("ZZ",)]
    assert result.ranked.filter("rank > 5").count() == 0


def _publish(spark, topic, users):
    streams.publish(spark.createDataFrame([(u,) for u in users], "user_id string"), "files", topic)


def test_stream_equals_batch_and_survives_restart(spark, metadata, maps):
    topic, offsets = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    recommend = _recommend(metadata, maps)

    def run():
        messages = streams.message_stream(spark, "files", topic)
        stream_recommendations(messages, recommend, table, offsets, trigger=None).awaitTermination()

    _publish(spark, topic, ["U1", "U2", "U2"])
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(topic)
    run()
    assert {r.user_id for r in table.read().collect()} == {"U1", "U2"}
    _publish(spark, topic, ["U3", "U1"])
    run()
    batch = recommend(spark.createDataFrame([("U1",), ("U2",), ("U3",)], "user_id string")).lists
    expected = {r.user_id: ",".join(r.top_k_asins) for r in batch.collect()}
    stored = {r.user_id: (r.recommendations, r.batch_id) for r in table.read().collect()}
    assert {u: v[0] for u, v in stored.items()} == expected
    assert {u: v[1] for u, v in stored.items()} == {"U1": 1, "U2": 0, "U3": 1}


def test_replayed_batch_leaves_the_table_unchanged(spark):
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    assert table.read().count() == 0
    first = spark.createDataFrame([("U1", ["a", "b"]), ("U2", ["c"])], "user_id string, top_k_asins array<string>")
    second = spark.createDataFrame([("U1", ["d"])], "user_id string, top_k_asins array<string>")
    for batch, lists in ((0, first), (1, second), (1, second), (0, first)):
        table.upsert(tables.keyed_rows(lists, batch), batch)
        if batch == 1:
            assert rows(table.read()) == [("U1", "d", 1), ("U2", "c", 0)]
    assert rows(table.read()) == [("U1", "d", 1), ("U2", "c", 0)]
    for _ in range(3):
        table.compact()
        assert rows(tables.KeyedTable(spark, table.path).read()) == [("U1", "d", 1), ("U2", "c", 0)]
    table.upsert(tables.keyed_rows(first, 2), 2)
    assert rows(table.read()) == [("U1", "a,b", 2), ("U2", "c", 2)]


def test_runs_do_not_overwrite_each_other(spark):
    """Batch numbers begin anew with a new checkpoint; a restart goes on with its own."""
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    lists = lambda *r: spark.createDataFrame(r, "user_id string, top_k_asins array<string>")

    def put(run, batch, *r):
        table.upsert(tables.keyed_rows(lists(*r), batch), batch, run=run)

    put("one", 0, ("U1", ["a"]), ("U2", ["b"]))
    put("one", 1, ("U3", ["c"]))
    put("two", 0, ("U1", ["d"]))
    again = tables.KeyedTable(spark, table.path)
    assert again.run_number("one") == 0 and again.run_number("two") == 1
    assert {r.user_id: r.recommendations for r in again.read().collect()} == {"U1": "d", "U2": "b", "U3": "c"}
    table.compact()
    put("two", 1, ("U2", ["e"]))
    table.compact()
    assert {r.user_id: r.recommendations for r in again.read().collect()} == {"U1": "d", "U2": "e", "U3": "c"}


def test_partition_writer(spark):
    seen = spark.sparkContext.accumulator(0)
    lists = spark.createDataFrame([("U1", ["a"]), ("U2", ["b"])], "user_id string, top_k_asins array<string>")
    tables.write_partitions(lists, lambda part: seen.add(sum(1 for _ in part)))
    assert seen.value == 2


def test_retrain_and_recommend_with_the_newest_model(spark, ratings, metadata):
    folder = scratch_path(spark, "store")
    tables.append_collection(ratings, f"{folder}/ratings")
    tables.append_collection(metadata, f"{folder}/metadata")
    registry = ModelRegistry(spark, f"{folder}/registry")
    none = spark.createDataFrame([], ACTION_MESSAGE)
    assert jobs.retrain(none, folder, registry, f"{folder}/maps") is None
    fresh = spark.createDataFrame([(2000, 5.0, "NEW", "P1"), (None, None, None, None)], ACTION_MESSAGE)
    options = dict(epochs=1, hidden=(4,), size=2)
    latest = jobs.LatestModel(registry, lambda: metadata, f"{folder}/maps")
    assert jobs.retrain(fresh, folder, registry, f"{folder}/maps", persist_batch=0, **options) == 0
    assert latest(fresh.select("user_id")).lists.count() == 1 and latest.version["version"] == 0
    assert jobs.retrain(fresh, folder, registry, f"{folder}/maps", persist_batch=0, **options) == 1
    kept = spark.read.parquet(f"{folder}/actions")
    assert kept.count() == 2
    requests = spark.createDataFrame([("NEW",), ("U3",)], "user_id string")
    result = latest(requests)
    assert latest.version["version"] == 1
    assert {r.user_id for r in result.lists.collect()} == {"NEW", "U3"}
    assert all(len(r.top_k_asins) >= 5 for r in result.lists.collect())
    once = [jobs.retrain(fresh, folder, registry, f"{folder}/maps", source="s:7", **options) for _ in range(2)]
    assert once == [2, 2] and registry.versions().count() == 3
    with pytest.raises(AnalysisException):
        jobs.retrain(fresh, f"{folder}/mistyped", registry, f"{folder}/maps", **options)


def test_stream_retrain_skips_empty_batches(spark, ratings, metadata):
    folder = scratch_path(spark, "store")
    tables.append_collection(ratings, f"{folder}/ratings")
    tables.append_collection(metadata, f"{folder}/metadata")
    registry = ModelRegistry(spark, f"{folder}/registry")
    topic, offsets = f"{folder}/topic", f"{folder}/offsets"
    actions = spark.createDataFrame([(2000, 5.0, "U1", "P1"), (2001, 1.0, "U2", "P2")], ACTION_MESSAGE)
    streams.publish(actions, "files", topic)
    for _ in range(2):
        stream_retraining(
            streams.message_stream(spark, "files", topic), folder, registry, f"{folder}/maps", offsets,
            trigger=None, persist=True, epochs=1, hidden=(), size=2,
        ).awaitTermination()
    assert rows(registry.versions().select("model", "version")) == [("DeepFM", 0)]
    assert spark.read.parquet(f"{folder}/actions").count() == 2


def test_console_sink_and_processing_time(spark):
    topic = scratch_path(spark, "topic")
    _publish(spark, topic, ["U1"])
    parsed = streams.parse_messages(streams.message_stream(spark, "files", topic), REQUEST_MESSAGE)
    stream = streams.append_sink(parsed, "console", checkpoint=scratch_path(spark, "offsets"))
    assert stream.awaitTermination(60)
    assert sum(p["numInputRows"] for p in stream.recentProgress) == 1
    seen = []
    ticking = each_batch(parsed, lambda df, n: seen.append(df.count()), scratch_path(spark, "o2"), "1 second")
    ticking.processAllAvailable()
    ticking.stop()
    assert sum(seen) == 1


def test_small_catalogue_from_request_to_list(spark):
    """Three shoppers, sixty goods on a line, a score that prefers goods near 7 * shopper + 3."""
    users = {"ana": 5, "ben": 0, "eve": 8}
    goods = [f"good-{n:02d}" for n in range(60)]
    maps = spark.createDataFrame(
        [(USER_MAP, name, idx) for name, idx in users.items()]
        + [(ITEM_MAP, name, n) for n, name in enumerate(goods)]
        + [(STORE_MAP, "shop", 0)],
        "feature string, value string, idx int",
    )
    catalogue = spark.createDataFrame([(name, "shop") for name in goods], METADATA)
    vectors = maps.select("feature", "idx", F.array(F.col("idx").cast("float")).alias("vector"))

    def nearest(items):
        return lambda asked: -abs(items[None, :, 0] - 7.0 * asked[:, [0]] - 3.0 + 0.25)

    requests = spark.createDataFrame([(u,) for u in users], "user_id string")
    items = jobs.candidate_items(catalogue, maps, vectors)
    lists = jobs.recommend(requests, items, maps, vectors, nearest).lists
    got = {r.user_id: r.top_k_asins for r in lists.collect()}
    for name, idx in users.items():
        wanted = sorted(range(60), key=lambda n: abs(n - 7 * idx - 3 + 0.25))[:5]
        assert got[name] == [goods[n] for n in wanted]


def test_files(spark, ratings, metadata):
    folder = scratch_path(spark, "files")
    files.write_jsonl(ratings, f"{folder}/r", compression="gzip")
    assert rows(files.read_jsonl(spark, f"{folder}/r", RATINGS, partitions=3)) == rows(ratings)
    files.write_dataset(ratings.dropna(), f"{folder}/csv", "csv")
    assert rows(files.read_csv(spark, f"{folder}/csv", RATINGS)) == rows(ratings.dropna())
    tables.append_collection(metadata.withColumn("_id", F.lit("x")), f"{folder}/c")
    assert tables.read_collection(spark, f"{folder}/c", METADATA).columns == METADATA.names
    assert tables.read_collection(spark, f"{folder}/none", METADATA).count() == 0


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError):
        streams.message_stream(spark, "socket", "x")
    with pytest.raises(ValueError):
        streams.publish(spark.range(1), "socket", "x")
