"""File readers and writers. Every read takes an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickwise.functions.scalars import join_list


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType, partitions: int | None = None
) -> DataFrame:
    """JSON lines, plain or ``.gz``. A gzip file cannot be split: give ``partitions`` to spread it."""
    df = spark.read.schema(schema).json(path)
    return df.repartition(partitions) if partitions else df


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All CSV parts in a folder, with header."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the dataset at ``path``, one part per task; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def write_recommendations_csv(lists: DataFrame, path: str) -> None:
    """Recommendation lists as CSV, items joined by comma."""
    flat = lists.select("user_id", join_list(F.col("top_k_asins")).alias("top_k_asins"))
    write_dataset(flat, path, "csv")
