"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, token ids.

Each stage takes the documents that the one before it kept, as Parquet, and its decisions take effect.
Stages 1 to 4 return rows with the columns of ``documents``, whole rows as they came unless the stage
changes the text:

* ``quality``: rows that the rules reject go.
* ``near_duplicates``: one row of each group stays, the one with the smallest id.
* ``decontaminate``: words of benchmark passages are cut out; rows mostly made of them go.
* ``secrets``: spans of secrets are replaced by a mark.
* ``encode``: token counts and digests of the ids and of the text decoded from them.

Null and empty texts fail the quality rules; an empty table passes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import bpe, decontam, minhash, quality, secret_scan
from pickwise.llm.queries import BYTE_BPE
from pickwise.llm.tables import table
from pickwise.workspace import materialize


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(docs, BYTE_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secrets", redact_secrets),
    ("encode", encode_tokens),
]

# Secrets are partly judged by a trained network and ids by merges, neither of which SQL can express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
