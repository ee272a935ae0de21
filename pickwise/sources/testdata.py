"""Views over the driver's tables in the layouts of ``schemas``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.functions.scalars import binarize, epoch_seconds
from pickwise.operators.relational import drop_nulls, join_ratings_metadata
from pickwise.operators.vocabulary import build_vocabularies
from pickwise.schemas import EMBEDDING_SIZE, ITEM_MAP, STORE_MAP, USER_MAP


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _rating():
    return (1 + (F.col("l_quantity").cast("long") - 1) % 5).cast("double")


def _text_id(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(
        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
        _rating().alias("rating"),
        _text_id("U", "o_custkey").alias("user_id"),
        _text_id("P", "l_partkey").alias("parent_asin"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue, with one brand turned into NULL stores."""
    return table(spark, sf_dir, "part").select(
        _text_id("P", "p_partkey").alias("parent_asin"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("store"),
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    rating = (
        F.when(kind == "purchase", 5).when(kind == "click", 3).when(kind == "view", 2)
        .when(kind == "signup", 1)
    )
    return table(spark, sf_dir, "events").select(
        epoch_seconds(F.col("ts")).cast("int").alias("timestamp"),
        rating.cast("float").alias("rating"),
        _text_id("U", "user_id").alias("user_id"),
        F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("parent_asin"),
    )


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of items with a known store."""
    both = join_ratings_metadata(ratings(spark, sf_dir), metadata(spark, sf_dir))
    return drop_nulls(both, ["store"])


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark, sf_dir).select(
        "user_id", "parent_asin", "store", binarize(F.col("rating")).alias("label")
    )


_FEATURE_COLUMNS = {USER_MAP: "user_id", ITEM_MAP: "parent_asin", STORE_MAP: "store"}


def vocabularies(spark: SparkSession, sf_dir: str, *features: str) -> DataFrame:
    """The vocabularies of the joined ratings, all three unless some are named."""
    names = features or tuple(_FEATURE_COLUMNS)
    return build_vocabularies(joined(spark, sf_dir), {f: _FEATURE_COLUMNS[f] for f in names})


def predictions(spark: SparkSession, sf_dir: str, score: str) -> DataFrame:
    """Scored (user, item) rows; one user has many rows, scores may tie."""
    return order_lines(spark, sf_dir).select(
        F.col("o_custkey").cast("int").alias("map_user_id"),
        F.col("l_partkey").cast("int").alias("parent_asin"),
        F.col(score).alias("predicted_rating"),
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logit and a label per order line."""
    return table(spark, sf_dir, "lineitem").select(
        ((F.col("l_quantity") - 25.0) / 10.0).alias("logit"), binarize(_rating()).alias("label")
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with one version per order, no two at the same time."""
    micros = (F.col("o_orderkey") / F.lit(1_000_000)).cast("decimal(18,6)")
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=micros)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model"),
        moment.alias("timestamp"),
        F.col("o_orderkey").cast("int").alias("version"),
    )


def training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per run and epoch, in the layout of the history table."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("run_id"), F.year("o_orderdate").alias("epoch")
        )
        .agg(
            F.min("o_totalprice").alias("train_loss"),
            F.max("o_totalprice").alias("train_roc_auc"),
            F.min(F.col("o_custkey").cast("double")).alias("test_loss"),
            F.max(F.col("o_custkey").cast("double")).alias("test_roc_auc"),
        )
    )


def keyed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations per user and rating, the rating standing for the batch number."""
    return (
        ratings(spark, sf_dir)
        .groupBy("user_id", F.col("rating").cast("long").alias("batch_id"))
        .agg(F.array(F.min("parent_asin"), F.max("parent_asin")).alias("top_k_asins"))
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.split("text", " ").alias("features")
    )


def digit_vectors(feature_maps: DataFrame) -> DataFrame:
    """Embeddings of small whole numbers, -8..7, read off the md5 digits of a value.

    Sums and products of them are exact, so any engine gives the same scores.
    """
    digest = F.md5(F.concat_ws("|", "feature", "value"))
    entries = [
        (F.instr(F.lit("0123456789abcdef"), F.substring(digest, j + 1, 1)) - 9).cast("float")
        for j in range(EMBEDDING_SIZE)
    ]
    return feature_maps.select("feature", "idx", F.array(*entries).alias("vector"))
