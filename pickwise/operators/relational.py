"""Projection, filter, join, union and counting operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.operators.skew import hot_keys, split_join
from pickwise.workspace import materialize


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=subset)


def replace_columns(df: DataFrame, replacements: dict[str, Column]) -> DataFrame:
    return df.withColumns(replacements)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def positive_rows(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) == 1)


def having_element(df: DataFrame, list_column: str, value) -> DataFrame:
    return df.filter(F.array_contains(list_column, value))


def join_ratings_metadata(ratings: DataFrame, metadata: DataFrame) -> DataFrame:
    """Inner join on the item. No hint: Spark broadcasts by measured size and splits hot items."""
    return ratings.join(metadata, "parent_asin")


def frequent_values(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Values of ``column`` occurring at least ``threshold`` times; NULL is never counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") >= threshold)
    )


def filter_low_occurrence(df: DataFrame, column: str, threshold: int = 5) -> DataFrame:
    """Rows whose ``column`` value occurs at least ``threshold`` times.

    The counts are written once: they also name the values too frequent for one task.
    """
    frequent = materialize(
        frequent_values(df, column, threshold).withColumnRenamed(column, "__value"), "frequent"
    )
    hot = hot_keys(frequent, ["__value"], "occurrences")
    return split_join(df, frequent, [column], ["__value"], "left_semi", hot)


def semi_join(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is among ``keys``.

    The distinct keys are written first: joined with a table instead of an aggregate, a
    frequent value can be split over tasks at run time.
    """
    known = materialize(keys.select(column).distinct(), "keys")
    return df.join(known, column, "left_semi")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values with their frequency, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def explode_value_counts(df: DataFrame, list_column: str, top: int = 50) -> DataFrame:
    """The ``top`` most frequent list elements; a top-k heap per task, never a full sort."""
    elements = df.select(F.explode(list_column).alias("value"))
    return value_counts(elements, "value").limit(top)


def union_all(*parts: DataFrame | None, fill_missing: bool = False) -> DataFrame:
    """UNION ALL by column name; absent parts are skipped."""
    present = [part for part in parts if part is not None]
    if not present:
        raise ValueError("nothing to union")
    result = present[0]
    for part in present[1:]:
        result = result.unionByName(part, allowMissingColumns=fill_missing)
    return result
