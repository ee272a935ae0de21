"""The user-level jobs: ingest, prepare, recommend, retrain, current version."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pickwise.models.embeddings import item_vectors, user_vectors
from pickwise.models.registry import ModelRegistry, current_version
from pickwise.models.training import train_model
from pickwise.operators.candidates import PairScorer, score_topk
from pickwise.operators.ranking import recommendation_lists
from pickwise.operators.relational import drop_nulls, project, union_all
from pickwise.operators.skew import hot_keys, split_join
from pickwise.operators.vocabulary import (
    build_vocabularies,
    build_vocabulary,
    decode,
    encode,
    item_feature_store,
    one_feature,
)
from pickwise.schemas import (
    ITEM_MAP,
    METADATA,
    METADATA_COLUMNS,
    RATING_COLUMNS,
    RATINGS,
    STORE_MAP,
    STREAM_EPOCHS,
    TOP_K,
    USER_MAP,
)
from pickwise.sources.files import read_jsonl
from pickwise.sources.tables import (
    append_collection,
    read_collection,
    read_feature_maps,
    write_feature_maps,
)
from pickwise.workspace import materialize


def ingest(spark: SparkSession, ratings_file: str, metadata_file: str, store: str) -> None:
    """JSON-lines files to the ``ratings`` and ``metadata`` collections under ``store``."""
    ratings = project(read_jsonl(spark, ratings_file, RATINGS), RATING_COLUMNS)
    metadata = project(read_jsonl(spark, metadata_file, METADATA), METADATA_COLUMNS)
    append_collection(ratings, f"{store}/ratings")
    append_collection(metadata, f"{store}/metadata")


def prepare(ratings: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings joined with known stores, as dense ids, and the vocabularies of that join.

    The catalogue is encoded before it meets the ratings: item and store ids come from the
    rated items alone, so the large table is shuffled for the catalogue join and the user
    lookup only. Rows per item and per user are counted on the way and name the hot keys of
    both joins. The joined rows are written once; they feed the user vocabulary and the result.
    """
    item_rows = _rows_per(ratings, "parent_asin")
    catalogue = materialize(
        drop_nulls(metadata, ["store"])
        .select(*METADATA_COLUMNS)
        .join(item_rows, "parent_asin", "left_semi"),
        "catalogue",
    )
    catalogue_maps = materialize(
        build_vocabularies(catalogue, {ITEM_MAP: "parent_asin", STORE_MAP: "store"}), "maps"
    )
    encoded_catalogue = encode(
        encode(catalogue, "store", one_feature(catalogue_maps, STORE_MAP), "minus_one"),
        "parent_asin", one_feature(catalogue_maps, ITEM_MAP), "minus_one", output="__item",
    ).withColumnRenamed("parent_asin", "__asin")
    joined = materialize(
        split_join(
            ratings, encoded_catalogue, ["parent_asin"], ["__asin"],
            hot=hot_keys(item_rows, ["parent_asin"], "rows"),
        ).select(F.col("__item").alias("parent_asin"), "timestamp", "rating", "user_id", "store"),
        "joined",
    )
    user_rows = _rows_per(joined, "user_id")
    user_map = materialize(build_vocabulary(user_rows, "user_id", USER_MAP), "user-map")
    dataset = encode(
        joined, "user_id", user_map, "minus_one", hot=hot_keys(user_rows, ["user_id"], "rows")
    ).select("parent_asin", "timestamp", "rating", "user_id", "store")
    return dataset, union_all(user_map, catalogue_maps)


def _rows_per(df: DataFrame, column: str) -> DataFrame:
    return materialize(df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")), "rows-per-key")


@dataclass
class Recommendations:
    ranked: DataFrame  # user_id, asin, rank
    lists: DataFrame  # user_id, top_k_asins
    unknown_users: DataFrame  # user_id


def candidate_items(
    metadata: DataFrame, feature_maps: DataFrame, embeddings: DataFrame
) -> DataFrame:
    """The catalogue as scoring input: a table of distinct (parent_asin, store_id, item_vector)."""
    items = item_feature_store(
        metadata, one_feature(feature_maps, ITEM_MAP), one_feature(feature_maps, STORE_MAP)
    ).distinct()
    known = item_vectors(items, embeddings, "parent_asin", "store_id").dropna(subset=["item_vector"])
    return materialize(known, "items")


def unknown_users(requests: DataFrame, user_map: DataFrame) -> DataFrame:
    """Requesting users without an id; they cannot be scored."""
    known = F.col("user_id") == F.col("value")
    return requests.select("user_id").distinct().join(user_map, known, "left_anti")


def recommend(
    requests: DataFrame,
    items: DataFrame,
    feature_maps: DataFrame,
    embeddings: DataFrame,
    scorer: PairScorer,
    k: int = TOP_K,
    exact: bool = False,
) -> Recommendations:
    """Top-k items per requesting user over all ``items`` (from ``candidate_items``).

    Requests are made distinct first; users without an id go to ``unknown_users``.
    """
    user_map = one_feature(feature_maps, USER_MAP)
    item_map = one_feature(feature_maps, ITEM_MAP)
    known = encode(
        requests.select("user_id").distinct(), "user_id", user_map, "drop", output="map_user_id"
    )
    users = user_vectors(known.select("map_user_id"), embeddings, "map_user_id").dropna()
    best = materialize(score_topk(materialize(users, "users"), items, scorer, k, exact), "best")
    # A popular item is in many lists.
    per_item = best.groupBy("parent_asin").agg(F.count(F.lit(1)).alias("rows"))
    hot_items = hot_keys(per_item, ["parent_asin"], "rows")
    named = decode(best, "map_user_id", user_map, "user_id")
    ranked = decode(named, "parent_asin", item_map, "asin", hot=hot_items)
    ranked = ranked.select("user_id", "asin", "rank")
    return Recommendations(ranked, recommendation_lists(ranked), unknown_users(requests, user_map))


class LatestModel:
    """Recommends with the newest registered model and the vocabularies it was trained with.

    Looks for a new version on every call, so a stream picks it up without a restart. The
    catalogue is read and encoded once per version, not once per call: an item new since then
    has no id and could not be scored anyway.
    """

    def __init__(
        self,
        registry: ModelRegistry,
        read_metadata: Callable[[], DataFrame],
        maps_path: str,
        k: int = TOP_K,
    ):
        self.registry, self.read_metadata, self.maps_path, self.k = (
            registry, read_metadata, maps_path, k
        )
        self.version, self.inputs = None, None

    def held(self) -> list[DataFrame]:
        """Scratch tables that later calls read again."""
        return [self.inputs[0]] if self.inputs else []

    def __call__(self, requests: DataFrame) -> Recommendations:
        newest = current_version(self.registry.versions()).head()
        if self.inputs is None or newest != self.version:
            network, embeddings, maps_version = self.registry.load()
            maps = read_feature_maps(self.registry.spark, self.maps_path, maps_version)
            items = candidate_items(self.read_metadata(), maps, embeddings)
            self.inputs = (items, maps, embeddings, network.pair_scorer())
            self.version = newest
        return recommend(requests, *self.inputs, k=self.k)


def retrain(
    actions: DataFrame | None,
    store: str,
    registry: ModelRegistry,
    maps_path: str,
    epochs: int = STREAM_EPOCHS,
    persist_batch: int | None = None,
    source: str | None = None,
    **training,
) -> int | None:
    """Train on stored ratings plus new ``actions`` and register the model; None if no actions.

    ``persist_batch`` also keeps the actions for later runs, once per batch number. A ``source``
    that a registered model names already (a replayed batch) is not trained again.
    """
    spark = registry.spark
    if source is not None and (version := registry.registered(source)) is not None:
        return version
    if actions is not None and actions.isEmpty():
        return None
    history = union_all(
        read_collection(spark, f"{store}/ratings", RATINGS, required=True),
        _kept_actions(spark, store, persist_batch)
    )
    if actions is not None:
        actions = actions.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RATINGS.fields]
        )
    metadata = read_collection(spark, f"{store}/metadata", METADATA, required=True)
    dataset, feature_maps = prepare(union_all(actions, history), metadata)
    dataset = materialize(dataset, "dataset")
    maps_version = uuid.uuid4().hex
    write_feature_maps(feature_maps, maps_path, maps_version)
    model = train_model(dataset, feature_maps, epochs=epochs, **training)
    if persist_batch is not None and actions is not None:
        actions.write.mode("overwrite").parquet(f"{store}/actions/batch={persist_batch}")
    # Last, so that a batch that stops before is done again as a whole.
    return registry.register(model, maps_version, source=source)


def _kept_actions(spark: SparkSession, store: str, current: int | None) -> DataFrame:
    """Actions kept by earlier batches, without a former attempt of the current one."""
    layout = StructType([*RATINGS.fields, StructField("batch", LongType())])
    kept = read_collection(spark, f"{store}/actions", layout)
    if current is not None:
        kept = kept.filter(F.col("batch") != current)
    return kept.select(*RATING_COLUMNS)
