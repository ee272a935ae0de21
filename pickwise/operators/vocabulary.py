"""Vocabularies (value to dense id) as tables, and lookups in them as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.ordering import hash_positions
from pickwise.operators.skew import split_join


def build_vocabularies(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct values per feature with ids 0..n-1, a table (feature, value, idx).

    ``columns`` names the column of each feature; all are built in one pass. Ids follow the md5
    order of the values, which is the same for every run and partitioning and needs no global
    sort. NULL, if present, is a value with an id of its own.
    """
    entries = F.array(
        *[
            F.struct(F.lit(feature).alias("feature"), F.col(column).cast("string").alias("value"))
            for feature, column in columns.items()
        ]
    )
    values = df.select(F.inline(entries)).distinct()
    return hash_positions(values, "ids", "idx", unique=True, group="feature").select(
        "feature", "value", F.col("idx").cast("int").alias("idx")
    )


def extend_vocabularies(known: DataFrame, df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``known`` with the new values of ``df`` appended: ids stay, new values get the next ids.

    The ids of a feature stay gapless if they were; new values take theirs in md5 order. Extending once
    more by the same rows changes nothing. ``known`` is read as rows of (feature, value, idx) and only the
    next id of each feature, a row per feature, is broadcast.
    """
    entries = F.array(
        *[
            F.struct(F.lit(feature).alias("feature"), F.col(column).cast("string").alias("value"))
            for feature, column in columns.items()
        ]
    )
    values = df.select(F.inline(entries)).distinct()
    held = known.select(F.col("feature").alias("__feature"), F.col("value").alias("__value"))
    same = (F.col("feature") == F.col("__feature")) & F.col("value").eqNullSafe(F.col("__value"))
    fresh = hash_positions(values.join(held, same, "left_anti"), "ids", "idx", unique=True, group="feature")
    following = known.groupBy("feature").agg((F.max("idx") + 1).alias("__next"))
    appended = fresh.join(F.broadcast(following), "feature", "left").select(
        "feature", "value", (F.col("idx") + F.coalesce("__next", F.lit(0))).cast("int").alias("idx")
    )
    return known.select("feature", "value", "idx").unionByName(appended)


def build_vocabulary(df: DataFrame, column: str, feature: str) -> DataFrame:
    return build_vocabularies(df, {feature: column})


def one_feature(feature_maps: DataFrame, feature: str) -> DataFrame:
    return feature_maps.filter(F.col("feature") == feature).select("value", "idx")


def invert_map(feature_map: DataFrame) -> DataFrame:
    """Id to value: the same table read the other way round."""
    return feature_map.select(F.col("idx").alias("key"), F.col("value").alias("original"))


def feature_sizes(feature_maps: DataFrame) -> DataFrame:
    return feature_maps.groupBy("feature").agg(F.count(F.lit(1)).alias("size"))


def encode(
    df: DataFrame,
    column: str,
    feature_map: DataFrame,
    missing: str,
    output: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Replace ``column`` by its id (or add ``output``).

    ``missing`` says what an unknown value gives: ``minus_one`` (NULL is looked up like any
    value), ``null`` or ``drop``. The join carries no hint: Spark broadcasts a vocabulary only
    if its measured size allows. ``hot`` names values that are joined without a shuffle.
    """
    if missing not in ("minus_one", "null", "drop"):
        raise ValueError(f"missing must be minus_one, null or drop, not {missing!r}")
    lookup = feature_map.select(
        F.col("value").alias("__value"), F.col("idx").cast("int").alias("__idx")
    )
    joined = split_join(
        df, lookup, [column], ["__value"],
        how="inner" if missing == "drop" else "left",
        hot=hot,
        null_safe=missing == "minus_one",
    )
    found = F.col("__idx")
    if missing == "minus_one":
        found = F.coalesce(found, F.lit(-1))
    return joined.withColumn(output or column, found).drop("__value", "__idx")


def decode(
    df: DataFrame, column: str, feature_map: DataFrame, output: str, hot: DataFrame | None = None
) -> DataFrame:
    """Add the original value of the id in ``column``; unknown ids give NULL.

    ``hot`` names ids that are looked up without a shuffle.
    """
    lookup = feature_map.select(
        F.col("idx").alias("__idx"), F.col("value").alias(output)
    )
    return split_join(df, lookup, [column], ["__idx"], how="left", hot=hot).drop("__idx")


def item_feature_store(
    metadata: DataFrame, item_map: DataFrame, store_map: DataFrame, sort: bool = False
) -> DataFrame:
    """Catalogue rows as ids (parent_asin, store_id); rows unknown to a vocabulary are dropped."""
    known = encode(metadata, "parent_asin", item_map, "drop")
    known = encode(known, "store", store_map, "drop", output="store_id")
    items = known.select("parent_asin", "store_id")
    return items.orderBy("parent_asin") if sort else items
