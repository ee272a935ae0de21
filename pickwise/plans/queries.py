"""The catalogue of queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pickwise.functions import scalars
from pickwise.models import embeddings, scoring
from pickwise.models import registry as reg
from pickwise.models.network import NORM_EPSILON, Network
from pickwise.models.training import TrainedModel, train_model
from pickwise.operators import metrics, ordering, ranking, relational, sampling, vocabulary
from pickwise.operators.candidates import fm_scorer, score_topk
from pickwise.plans import jobs
from pickwise.schemas import (
    ACTION_MESSAGE,
    EMBEDDING_SIZE,
    HISTORY,
    ITEM_MAP,
    METADATA,
    RATING_COLUMNS,
    RATINGS,
    REQUEST_MESSAGE,
    STORE_MAP,
    USER_MAP,
)
from pickwise.sources import files, streams, tables, testdata
from pickwise.streaming.jobs import each_batch, stream_recommendations, stream_retraining
from pickwise.workspace import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks ---------------------------------------------------------------------


@query
def scan_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl-gz")
    files.write_jsonl(testdata.ratings(spark, sf_dir), path, compression="gzip")
    return files.read_jsonl(spark, path, RATINGS)


@query
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_dataset(testdata.joined(spark, sf_dir), path, "csv")
    layout = StructType([*RATINGS.fields[3:], *RATINGS.fields[:3], METADATA.fields[1]])
    return files.read_csv(spark, path, layout)


@query
def scan_parquet(spark, sf_dir):
    """A filter that reaches the scan is the feature here; ``scan_parquet_whole`` reads all rows."""
    scan = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return scan.filter(F.col("l_quantity") >= 45).select("l_orderkey", "l_partkey", "l_quantity")


@query
def scan_parquet_whole(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@query
def scan_collection(spark, sf_dir):
    path = scratch_path(spark, "collection")
    tables.append_collection(
        testdata.metadata(spark, sf_dir).withColumn("_id", F.col("parent_asin")), path
    )
    layout = StructType([*METADATA.fields, StructField("_id", StringType())])
    return tables.read_collection(spark, path, layout)


@query
def inline_relation(spark, sf_dir):
    names = spark.createDataFrame(
        [(1.0, "poor"), (2.0, "fair"), (3.0, "good"), (4.0, "fine"), (5.0, "best")],
        "rating double, name string",
    )
    counts = testdata.ratings(spark, sf_dir).groupBy("rating").agg(F.count("*").alias("n"))
    return counts.join(names, "rating").select("name", "n")


@query
def scan_feature_maps(spark, sf_dir):
    path = scratch_path(spark, "maps")
    maps = testdata.vocabularies(spark, sf_dir, ITEM_MAP, STORE_MAP)
    tables.write_feature_maps(maps, path, "v1")
    stored = tables.read_feature_maps(spark, path, "v1")
    return vocabulary.one_feature(stored, STORE_MAP)


@query
def sink_feature_maps(spark, sf_dir):
    path = scratch_path(spark, "maps")
    tables.write_feature_maps(testdata.vocabularies(spark, sf_dir), path, "v1")
    return tables.read_feature_maps(spark, path, "v1")


@query
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    files.write_dataset(testdata.ratings(spark, sf_dir), path, "csv")
    return files.read_csv(spark, path, RATINGS)


@query
def sink_append(spark, sf_dir):
    """Two appends to one collection: stored ratings, then the actions."""
    path = scratch_path(spark, "ratings")
    tables.append_collection(testdata.ratings(spark, sf_dir), path)
    tables.append_collection(
        testdata.actions(spark, sf_dir).select(
            *[F.col(f.name).cast(f.dataType) for f in RATINGS.fields]
        ),
        path,
    )
    return tables.read_collection(spark, path, RATINGS)


@query
def kv_upsert(spark, sf_dir):
    """Five batches upserted in turn; the last one again, as after a failed attempt."""
    rows = materialize(testdata.keyed_batches(spark, sf_dir), "batches")
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    for batch in (1, 2, 3, 4, 5, 5):
        part = rows.filter(F.col("batch_id") == batch)
        table.upsert(tables.keyed_rows(part, batch), batch)
    return table.read()


@query
def scan_recommendations(spark, sf_dir):
    """A stored table of two runs, compacted between them; the later run has the larger ratings."""
    rows = materialize(testdata.keyed_batches(spark, sf_dir), "batches")
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    for run, batches in (("first", (1, 2, 3)), ("second", (4, 5))):
        for number, batch in enumerate(batches):
            lists = rows.filter(F.col("batch_id") == batch)
            table.upsert(tables.keyed_rows(lists, number), number, run=run)
        table.compact()
    return tables.KeyedTable(spark, table.path).read().select("user_id", "recommendations")


@query
def sink_recommendations_csv(spark, sf_dir):
    path = scratch_path(spark, "lists")
    files.write_recommendations_csv(testdata.keyed_batches(spark, sf_dir), path)
    layout = StructType(
        [StructField("user_id", StringType()), StructField("top_k_asins", StringType())]
    )
    return files.read_csv(spark, path, layout)


@query
def sink_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    files.write_jsonl(testdata.metadata(spark, sf_dir), path)
    return files.read_jsonl(spark, path, METADATA)


@query
def sink_history(spark, sf_dir):
    path = scratch_path(spark, "history")
    tables.append_collection(testdata.training_history(spark, sf_dir), path)
    return tables.read_collection(spark, path, HISTORY)


@query
def registry_append(spark, sf_dir):
    path = scratch_path(spark, "versions")
    versions = testdata.model_versions(spark, sf_dir)
    tables.append_collection(versions, path)
    stored = tables.read_collection(spark, path, versions.schema)
    newest = reg.next_version(stored)
    return stored.agg(F.count("*").alias("n_versions")).withColumn(
        "next_version", newest.scalar()
    )


@query
def publish_json(spark, sf_dir):
    path = scratch_path(spark, "topic")
    streams.publish(testdata.actions(spark, sf_dir), "files", path)
    return streams.parse_messages(spark.read.text(path), ACTION_MESSAGE)


# --- projection, filters, scalar functions ---------------------------------------------------


@query
def project_columns(spark, sf_dir):
    return relational.project(testdata.joined(spark, sf_dir), RATING_COLUMNS)


@query
def drop_null_store(spark, sf_dir):
    return relational.drop_nulls(testdata.metadata(spark, sf_dir), ["store"])


@query
def drop_null_any(spark, sf_dir):
    return relational.drop_nulls(testdata.actions(spark, sf_dir))


@query
def drop_columns(spark, sf_dir):
    return testdata.ratings(spark, sf_dir).drop("rating")


@query
def replace_columns(spark, sf_dir):
    return relational.replace_columns(
        testdata.ratings(spark, sf_dir),
        {
            "rating": F.col("rating") * 2,
            "parent_asin": F.substring("parent_asin", 2, 20).cast("int"),
        },
    )


@query
def cast_columns(spark, sf_dir):
    messages = testdata.actions(spark, sf_dir).select(
        F.encode("user_id", "utf-8").alias("user_id"), "timestamp", "rating"
    )
    return relational.cast_columns(
        messages, {"user_id": "string", "timestamp": "string", "rating": "int"}
    )


@query
def binarize_rating(spark, sf_dir):
    return testdata.actions(spark, sf_dir).select(
        "user_id", "rating", scalars.binarize(F.col("rating")).alias("label")
    )


@query
def positive_rows(spark, sf_dir):
    return relational.positive_rows(testdata.labelled(spark, sf_dir))


@query
def array_contains_filter(spark, sf_dir):
    return relational.having_element(testdata.words(spark, sf_dir), "features", "the").select(
        "doc_id"
    )


@query
def filter_low_occurrence(spark, sf_dir):
    return relational.filter_low_occurrence(testdata.joined(spark, sf_dir), "user_id", 30)


@query
def parse_actions_json(spark, sf_dir):
    """Messages with a bad text, a time beyond int and a wrong type among them."""
    good = F.concat(
        F.lit('{"timestamp":'), scalars.epoch_seconds(F.col("ts")).cast("string"),
        F.lit(',"rating":4.0,"user_id":"U'), F.col("user_id").cast("string"),
        F.lit('","parent_asin":"P'), F.get_json_object("props", "$.k"), F.lit('"}'),
    )
    kind = F.col("event_type")
    message = (
        F.when(kind == "error", F.lit("not json"))
        .when(kind == "signup", F.regexp_replace(good, '("timestamp":\\d+)', "$1000"))
        .when(kind == "click", F.replace(good, F.lit("4.0"), F.lit('"x"')))
        .otherwise(good)
    )
    events = testdata.table(spark, sf_dir, "events").select("event_id", message.alias("value"))
    return events.select(
        "event_id", scalars.parse_json(F.col("value"), ACTION_MESSAGE).alias("data")
    ).select("event_id", "data.*")


@query
def encode_json(spark, sf_dir):
    return testdata.ratings(spark, sf_dir).select(
        scalars.encode_json("user_id", "parent_asin", "timestamp").alias("value")
    )


@query
def map_lookup(spark, sf_dir):
    weights = {"purchase": 5, "click": 3, "view": 2, "signup": 1}
    return testdata.table(spark, sf_dir, "events").select(
        "event_id", scalars.map_lookup(weights, F.col("event_type")).alias("weight")
    )


@query
def invert_map(spark, sf_dir):
    return vocabulary.invert_map(testdata.vocabularies(spark, sf_dir, STORE_MAP))


@query
def feature_vector(spark, sf_dir):
    vector = scalars.feature_vector("map_user_id", "parent_asin", F.col("predicted_rating").cast("int"))
    return testdata.predictions(spark, sf_dir, "l_quantity").select(
        scalars.join_list(vector.cast("array<string>")).alias("vector")
    )


@query
def join_list(spark, sf_dir):
    return testdata.keyed_batches(spark, sf_dir).select(
        "user_id", "batch_id", scalars.join_list(F.col("top_k_asins")).alias("recommendations")
    )


@query
def sigmoid(spark, sf_dir):
    return testdata.scored_labels(spark, sf_dir).select(
        "logit", F.round(scalars.sigmoid(F.col("logit")), 9).alias("probability")
    )


@query
def format_id(spark, sf_dir):
    return testdata.table(spark, sf_dir, "part").select(
        "p_partkey", scalars.format_id(F.col("p_partkey")).alias("item")
    )


@query
def run_id(spark, sf_dir):
    return testdata.table(spark, sf_dir, "events").select(
        "event_id", scalars.run_id(F.col("ts")).alias("run_id")
    )


@query
def epoch_seconds(spark, sf_dir):
    return testdata.table(spark, sf_dir, "events").select(
        "event_id", scalars.epoch_seconds(F.col("ts")).alias("seconds")
    )


# --- joins and lookups -------------------------------------------------------------------------


@query
def join_ratings_metadata(spark, sf_dir):
    return relational.join_ratings_metadata(
        testdata.ratings(spark, sf_dir), testdata.metadata(spark, sf_dir)
    )


@query
def semi_join_users(spark, sf_dir):
    """Ratings of users who also sent actions."""
    users = testdata.actions(spark, sf_dir)
    return relational.semi_join(testdata.ratings(spark, sf_dir), users, "user_id")


def _all_items(spark, sf_dir):
    return testdata.ratings(spark, sf_dir).select("user_id", "parent_asin", "timestamp")


@query
def encode_minus_one(spark, sf_dir):
    return vocabulary.encode(
        _all_items(spark, sf_dir), "parent_asin",
        testdata.vocabularies(spark, sf_dir, ITEM_MAP), "minus_one",
    )


@query
def encode_null(spark, sf_dir):
    return vocabulary.encode(
        _all_items(spark, sf_dir), "parent_asin",
        testdata.vocabularies(spark, sf_dir, ITEM_MAP), "null", output="map_item_id",
    )


@query
def item_feature_store(spark, sf_dir):
    maps = materialize(testdata.vocabularies(spark, sf_dir, ITEM_MAP, STORE_MAP), "maps")
    return vocabulary.item_feature_store(
        testdata.metadata(spark, sf_dir),
        vocabulary.one_feature(maps, ITEM_MAP),
        vocabulary.one_feature(maps, STORE_MAP),
    )


@query
def decode_entities(spark, sf_dir):
    """Top scored rows by id, mapped back to the original users and items."""
    maps = materialize(testdata.vocabularies(spark, sf_dir, USER_MAP, ITEM_MAP), "maps")
    users, items = vocabulary.one_feature(maps, USER_MAP), vocabulary.one_feature(maps, ITEM_MAP)
    best = ranking.topk_with_ties(
        testdata.predictions(spark, sf_dir, "l_extendedprice"), "map_user_id", "predicted_rating"
    )
    named = vocabulary.decode(best, "map_user_id", users, "user_id")
    return vocabulary.decode(named, "parent_asin", items, "asin").select("user_id", "asin", "rank")


# --- aggregates --------------------------------------------------------------------------------


@query
def distinct_values(spark, sf_dir):
    return relational.distinct_values(testdata.joined(spark, sf_dir), "parent_asin")


@query
def feature_map_user(spark, sf_dir):
    return testdata.vocabularies(spark, sf_dir, USER_MAP)


@query
def feature_maps_extended(spark, sf_dir):
    """Vocabularies of the best ratings, then appended to for all the others."""
    columns = {USER_MAP: "user_id", ITEM_MAP: "parent_asin"}
    joined = materialize(testdata.joined(spark, sf_dir), "joined")
    best = materialize(vocabulary.build_vocabularies(joined.filter("rating = 5"), columns), "maps")
    return vocabulary.extend_vocabularies(best, joined, columns)


@query
def feature_map_item(spark, sf_dir):
    return testdata.vocabularies(spark, sf_dir, ITEM_MAP)


@query
def feature_map_store(spark, sf_dir):
    return testdata.vocabularies(spark, sf_dir, STORE_MAP)


@query
def feature_sizes(spark, sf_dir):
    return vocabulary.feature_sizes(testdata.vocabularies(spark, sf_dir))


@query
def value_counts(spark, sf_dir):
    return relational.value_counts(testdata.joined(spark, sf_dir), "user_id")


@query
def explode_value_counts(spark, sf_dir):
    return relational.explode_value_counts(testdata.words(spark, sf_dir), "features", 50)


@query
def recommendation_lists(spark, sf_dir):
    ranked = ranking.topk_exact(
        testdata.predictions(spark, sf_dir, "l_extendedprice"),
        "map_user_id", "predicted_rating", ["parent_asin"],
    ).select(
        scalars.format_id(F.col("map_user_id"), "U").alias("user_id"),
        scalars.format_id(F.col("parent_asin"), "P").alias("asin"),
        "rank",
    )
    return ranking.recommendation_lists(ranked).select(
        "user_id", scalars.join_list(F.col("top_k_asins")).alias("top_k_asins")
    )


@query
def split_counts(spark, sf_dir):
    split = sampling.train_test_split(materialize(testdata.labelled(spark, sf_dir), "labelled"))
    return split.groupBy("split").agg(F.count("*").alias("n"))


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(testdata.scored_labels(spark, sf_dir), "logit", "label")


@query
def bce_logits_loss(spark, sf_dir):
    loss = metrics.mean_log_loss(testdata.scored_labels(spark, sf_dir), "logit", "label")
    return loss.select(F.round("loss", 9).alias("loss"))


@query
def next_model_version(spark, sf_dir):
    return reg.next_version(testdata.model_versions(spark, sf_dir))


# --- order, ranks, positions -------------------------------------------------------------------


@query
def rank_predictions(spark, sf_dir):
    return ranking.rank_rows(
        testdata.predictions(spark, sf_dir, "l_quantity"), "map_user_id", "predicted_rating"
    )


@query
def topk_per_user(spark, sf_dir):
    return ranking.topk_with_ties(
        testdata.predictions(spark, sf_dir, "l_quantity"), "map_user_id", "predicted_rating"
    )


@query
def topk_per_user_exact(spark, sf_dir):
    return ranking.topk_exact(
        testdata.predictions(spark, sf_dir, "l_quantity"),
        "map_user_id", "predicted_rating", ["parent_asin"],
    )


@query
def topk_repeated_requests(spark, sf_dir):
    """Ranks when a user asks several times in one batch and every copy is ranked."""
    requests = testdata.table(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("int").alias("map_user_id")
    ).agg(F.count("*").alias("repeats"))
    ranked = ranking.topk_with_ties(
        testdata.predictions(spark, sf_dir, "l_extendedprice"),
        "map_user_id", "predicted_rating", k=200,
    )
    return ranking.ranks_with_repeats(ranked, requests, "map_user_id", k=200).select(
        "map_user_id", "parent_asin", "predicted_rating", "rank", "copies"
    )


@query
def latest_model_version(spark, sf_dir):
    return reg.latest_version(testdata.model_versions(spark, sf_dir))


@query
def last_registered_model(spark, sf_dir):
    return reg.last_registered(testdata.model_versions(spark, sf_dir))


@query
def current_model_version(spark, sf_dir):
    return reg.current_version(testdata.model_versions(spark, sf_dir))


@query
def sort_by_time(spark, sf_dir):
    return ordering.sort_by(testdata.ratings(spark, sf_dir), "timestamp", "user_id", "parent_asin")


@query
def row_position(spark, sf_dir):
    rated = testdata.ratings(spark, sf_dir).select("parent_asin", "user_id")
    return ordering.sorted_positions(rated, ["parent_asin"])


@query
def temporal_split(spark, sf_dir):
    rows = materialize(testdata.ratings(spark, sf_dir), "ratings")
    return ordering.temporal_split(rows, "timestamp", 0.8)


@query
def tail_fraction(spark, sf_dir):
    rows = materialize(testdata.ratings(spark, sf_dir), "ratings")
    return ordering.tail_fraction(rows, "timestamp", 0.9)


# --- unions, sampling ----------------------------------------------------------------------------


@query
def union_stream_history(spark, sf_dir):
    fresh = testdata.actions(spark, sf_dir).select(
        *[F.col(f.name).cast(f.dataType) for f in RATINGS.fields]
    )
    return relational.union_all(fresh, None, testdata.ratings(spark, sf_dir))


@query
def union_missing_columns(spark, sf_dir):
    pairs = testdata.actions(spark, sf_dir).select("parent_asin", "user_id")
    return relational.union_all(pairs, testdata.ratings(spark, sf_dir), fill_missing=True)


@query
def train_test_split(spark, sf_dir):
    return sampling.train_test_split(materialize(testdata.labelled(spark, sf_dir), "labelled"))


@query
def negative_sampling(spark, sf_dir):
    return sampling.negative_sampling(testdata.labelled(spark, sf_dir))


@query
def negative_sampling_k3(spark, sf_dir):
    return sampling.negative_sampling(testdata.labelled(spark, sf_dir), k=3)


@query
def negative_sampling_strict(spark, sf_dir):
    """Negatives that repeat a positive are left out."""
    return sampling.negative_sampling(testdata.labelled(spark, sf_dir), exclude_positives=True)


@query
def sample_with_replacement(spark, sf_dir):
    users = vocabulary.one_feature(testdata.vocabularies(spark, sf_dir, USER_MAP), USER_MAP)
    return sampling.sample_with_replacement(materialize(users, "users"), 50)


@query
def sample_rows(spark, sf_dir):
    return sampling.sample_rows(testdata.ratings(spark, sf_dir), 10)


@query
def minibatch_assignment(spark, sf_dir):
    return sampling.minibatches(testdata.labelled(spark, sf_dir))


# --- models ------------------------------------------------------------------------------------


def _feature_maps(spark, sf_dir) -> DataFrame:
    return materialize(testdata.vocabularies(spark, sf_dir), "maps")


def _prepared(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    dataset, maps = jobs.prepare(testdata.ratings(spark, sf_dir), testdata.metadata(spark, sf_dir))
    return materialize(dataset, "dataset"), maps


@query
def fm_cross_term(spark, sf_dir):
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100.0).cast("double"))
    return testdata.table(spark, sf_dir, "embeddings").select(
        "vec_id", scalars.fm_cross_term(whole).alias("cross_term")
    )


def _encoded(spark, sf_dir):
    """Vocabularies and (user_id, parent_asin, store) id rows of the joined ratings."""
    dataset, maps = _prepared(spark, sf_dir)
    return maps, dataset.select("user_id", "parent_asin", "store")


@query
def embedding_lookup(spark, sf_dir):
    maps, rows = _encoded(spark, sf_dir)
    vectors = embeddings.embedding_lookup(rows, testdata.digit_vectors(maps))
    text = F.col("vector").cast("array<int>").cast("array<string>")
    return vectors.select(
        "user_id", "parent_asin", "store", scalars.join_list(text).alias("vector")
    )


def linear_model():
    """Stand-in model with exact arithmetic: a whole-number hash of the three ids."""

    def predict(inputs: np.ndarray) -> np.ndarray:
        ids = inputs.astype(np.int64)
        return (((ids @ np.array([2, 3, 5])) % 17 - 8) / 4.0).astype(np.float32)[:, None]

    return predict


@query
def batch_predict(spark, sf_dir):
    _, rows = _encoded(spark, sf_dir)
    return scoring.batch_predict(rows, ["user_id", "parent_asin", "store"], linear_model)


@query
def evaluate_model(spark, sf_dir):
    dataset, _ = _prepared(spark, sf_dir)
    rows = dataset.withColumn("label", scalars.binarize(F.col("rating")))
    scored = materialize(
        scoring.batch_predict(rows, ["user_id", "parent_asin", "store"], linear_model, "logit").select(
            "logit", "label"
        ),
        "scored",
    )
    loss = metrics.mean_log_loss(scored, "logit", "label").select(F.round("loss", 9).alias("loss"))
    return loss.withColumn("roc_auc", metrics.roc_auc(scored, "logit", "label").scalar())


def whole_number_network() -> Network:
    """A small network of whole numbers, so that any engine gives the same logits."""
    network = Network.start(3 * EMBEDDING_SIZE, (3, 2))
    for name, values in network.arrays.items():
        kind, layer = name[:-1], int(name[-1])
        if kind == "weight":
            row, column = np.indices(values.shape)
            values[:] = (7 * row + 3 * column + layer) % 5 - 2
        elif kind == "bias":
            values[:] = np.arange(len(values)) - 1
        else:
            # The variance makes the norm's divisor exactly one.
            values[:] = {"scale": 1.0, "var": 1.0 - NORM_EPSILON}.get(kind, 0.0)
    return network


@query
def deepfm_score(spark, sf_dir):
    maps, rows = _encoded(spark, sf_dir)
    return scoring.score_rows(rows, testdata.digit_vectors(maps), whole_number_network())


def _progress(spark, model: TrainedModel) -> DataFrame:
    """Per epoch whether the metrics are proper numbers and training lowered the loss, and what was trained."""
    lowered = model.history[-1]["train_loss"] < model.history[0]["train_loss"]
    sizes = {r["feature"]: r["count"] for r in model.embeddings.groupBy("feature").count().collect()}
    counts = [model.rows["train"], model.rows["validation"], *map(sizes.get, (USER_MAP, ITEM_MAP, STORE_MAP))]
    rows = []
    for entry in model.history:
        losses, areas = ([entry[f"{s}_{m}"] for s in ("train", "test")] for m in ("loss", "roc_auc"))
        proper = all(x is not None and 0 <= x < math.inf for x in losses) and all(
            x is not None and 0 <= x <= 1 for x in areas
        )
        rows.append((model.name, entry["epoch"], proper, lowered, *counts))
    layout = "model string, epoch int, proper boolean, lowered boolean, n_train long, n_validation long"
    return spark.createDataFrame(rows, layout + ", n_users long, n_items long, n_stores long")


@query
def train_deepfm(spark, sf_dir):
    return _progress(spark, train_model(*_prepared(spark, sf_dir)))


@query
def train_fm(spark, sf_dir):
    return _progress(spark, train_model(*_prepared(spark, sf_dir), hidden=(), name="FM"))


@query
def registry_roundtrip(spark, sf_dir):
    """Register a model twice, load the newest and count its vectors per feature."""
    maps = _feature_maps(spark, sf_dir)
    registry = reg.ModelRegistry(spark, scratch_path(spark, "registry"))
    model = TrainedModel(Network.start(3 * EMBEDDING_SIZE), embeddings.normal_embeddings(maps))
    registry.register(model, "v1")
    version = registry.register(model, "v2")
    _, vectors, maps_version = registry.load()
    return vectors.groupBy("feature").agg(F.count("*").alias("n")).withColumns(
        {"version": F.lit(version), "maps_version": F.lit(maps_version)}
    )


# --- jobs --------------------------------------------------------------------------------------


@query
def ingest_collections(spark, sf_dir):
    folder = scratch_path(spark, "ingest")
    files.write_jsonl(
        testdata.ratings(spark, sf_dir).withColumn("title", F.lit("not kept")), f"{folder}/in-ratings"
    )
    files.write_jsonl(testdata.metadata(spark, sf_dir), f"{folder}/in-metadata")
    jobs.ingest(spark, f"{folder}/in-ratings", f"{folder}/in-metadata", folder)
    stored = tables.read_collection(spark, f"{folder}/ratings", RATINGS)
    return stored.join(tables.read_collection(spark, f"{folder}/metadata", METADATA), "parent_asin")


@query
def prepare_dataset(spark, sf_dir):
    dataset, _ = jobs.prepare(testdata.ratings(spark, sf_dir), testdata.metadata(spark, sf_dir))
    return dataset


def _recommender(spark, sf_dir) -> Callable[[DataFrame], jobs.Recommendations]:
    maps = _feature_maps(spark, sf_dir)
    vectors = testdata.digit_vectors(maps)
    items = jobs.candidate_items(testdata.metadata(spark, sf_dir), maps, vectors)
    return lambda requests: jobs.recommend(requests, items, maps, vectors, fm_scorer)


@query
def recommend_topk(spark, sf_dir):
    requests = testdata.actions(spark, sf_dir).select("user_id")
    result = _recommender(spark, sf_dir)(requests)
    return result.lists.select(
        "user_id", scalars.join_list(F.col("top_k_asins")).alias("recommendations")
    )


@query
def recommend_latest_model(spark, sf_dir):
    """The whole path: a registered model with its vocabularies, found again and used."""
    folder, maps = scratch_path(spark, "latest"), _feature_maps(spark, sf_dir)
    registry = reg.ModelRegistry(spark, f"{folder}/registry")
    tables.write_feature_maps(maps, f"{folder}/maps", "v1")
    registry.register(TrainedModel(whole_number_network(), testdata.digit_vectors(maps)), "v1")
    latest = jobs.LatestModel(registry, lambda: testdata.metadata(spark, sf_dir), f"{folder}/maps")
    result = latest(testdata.actions(spark, sf_dir).select("user_id"))
    return result.lists.select(
        "user_id", scalars.join_list(F.col("top_k_asins")).alias("recommendations")
    )


@query
def sink_sampled_users(spark, sf_dir):
    """Users drawn with replacement, written to CSV and read back."""
    path = scratch_path(spark, "sampled")
    users = vocabulary.one_feature(testdata.vocabularies(spark, sf_dir, USER_MAP), USER_MAP)
    drawn = sampling.sample_with_replacement(materialize(users, "users"), 50)
    files.write_dataset(drawn.select("value"), path, "csv")
    return files.read_csv(spark, path, StructType([StructField("value", StringType())]))


@query
def unknown_requests(spark, sf_dir):
    """Requesting customers without an id, the output for users that cannot be scored."""
    requests = testdata.table(spark, sf_dir, "customer").select(
        scalars.format_id(F.col("c_custkey") * 2, "U").alias("user_id")
    )
    users = vocabulary.one_feature(testdata.vocabularies(spark, sf_dir, USER_MAP), USER_MAP)
    return jobs.unknown_users(requests, users)


@query
def candidate_scoring(spark, sf_dir):
    """Every known user against every item, best three by id; no row per pair exists."""
    maps = _feature_maps(spark, sf_dir)
    vectors = testdata.digit_vectors(maps)
    users = vocabulary.one_feature(maps, USER_MAP).select(F.col("idx").alias("map_user_id"))
    users = materialize(embeddings.user_vectors(users, vectors, "map_user_id"), "users")
    items = jobs.candidate_items(testdata.metadata(spark, sf_dir), maps, vectors)
    return score_topk(users, items, fm_scorer, k=3, exact=True)


def _registered(registry: reg.ModelRegistry) -> DataFrame:
    """The newest model, its epochs and the users it has vectors for."""
    _, vectors, _ = registry.load()
    return reg.current_version(registry.versions()).select(
        "model", "version",
        registry.history().agg(F.count("*").alias("epochs")).scalar().alias("epochs"),
        vectors.filter(F.col("feature") == USER_MAP).agg(F.count("*").alias("n")).scalar().alias("n_users"),
    )


@query
def retrain(spark, sf_dir):
    folder = scratch_path(spark, "retrain")
    tables.append_collection(testdata.ratings(spark, sf_dir), f"{folder}/ratings")
    tables.append_collection(testdata.metadata(spark, sf_dir), f"{folder}/metadata")
    registry = reg.ModelRegistry(spark, f"{folder}/registry")
    jobs.retrain(testdata.actions(spark, sf_dir), folder, registry, f"{folder}/maps")
    return _registered(registry)


# --- streams -----------------------------------------------------------------------------------


def _topic(spark, rows: DataFrame) -> str:
    path = scratch_path(spark, "topic")
    streams.publish(rows, "files", path)
    return path


def _through_stream(spark, rows: DataFrame, layout: StructType) -> DataFrame:
    """Publish rows, read them as a stream, append them to a folder, read the folder."""
    topic, out = _topic(spark, rows), scratch_path(spark, "stream-out")
    parsed = streams.parse_messages(streams.message_stream(spark, "files", topic), layout)
    streams.append_sink(
        parsed, "parquet", checkpoint=scratch_path(spark, "offsets"), path=out
    ).awaitTermination()
    return spark.read.schema(layout).parquet(out)


@query
def stream_requests(spark, sf_dir):
    return _through_stream(
        spark, testdata.actions(spark, sf_dir).select("user_id"), REQUEST_MESSAGE
    )


@query
def stream_actions(spark, sf_dir):
    return _through_stream(spark, testdata.actions(spark, sf_dir), ACTION_MESSAGE)


@query
def stream_recommend(spark, sf_dir):
    topic = _topic(spark, testdata.actions(spark, sf_dir).select("user_id"))
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))
    stream_recommendations(
        streams.message_stream(spark, "files", topic), _recommender(spark, sf_dir),
        table, scratch_path(spark, "offsets"), trigger=None,
    ).awaitTermination()
    return table.read().select("user_id", "recommendations")


@query
def stream_restart(spark, sf_dir):
    """Stop after the clicks, publish everything else, go on from the checkpoint."""
    topic, offsets = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"))

    def handle(requests: DataFrame, batch_id: int) -> None:
        lists = requests.select("user_id").distinct().select(
            "user_id", F.array(scalars.format_id(F.col("user_id"))).alias("top_k_asins")
        )
        table.upsert(tables.keyed_rows(lists, batch_id), batch_id)

    events = testdata.table(spark, sf_dir, "events").select(
        scalars.format_id(F.col("user_id"), "U").alias("user_id"), "event_type"
    )
    clicks = F.col("event_type") == "click"
    for part in (events.filter(clicks), events.filter(~clicks)):
        streams.publish(part.select("user_id"), "files", topic)
        messages = streams.message_stream(spark, "files", topic)
        parsed = streams.parse_messages(messages, REQUEST_MESSAGE)
        each_batch(parsed, handle, offsets, None).awaitTermination()
    return table.read()


@query
def stream_retrain(spark, sf_dir):
    folder = scratch_path(spark, "stream-retrain")
    tables.append_collection(testdata.ratings(spark, sf_dir), f"{folder}/ratings")
    tables.append_collection(testdata.metadata(spark, sf_dir), f"{folder}/metadata")
    registry = reg.ModelRegistry(spark, f"{folder}/registry")
    stream_retraining(
        streams.message_stream(spark, "files", _topic(spark, testdata.actions(spark, sf_dir))),
        folder, registry, f"{folder}/maps", scratch_path(spark, "offsets"),
        trigger=None,
    ).awaitTermination()
    return _registered(registry)
