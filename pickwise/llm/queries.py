"""The queries of this subpackage, on the driver's tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import (
    bpe,
    chat,
    decontam,
    html_text,
    minhash,
    pii,
    quality,
    secret_scan,
    sharding,
    spelling,
    substrings,
    token_counts,
    whitening,
)
from pickwise.llm.oracle import ORACLE_SQL
from pickwise.llm.tables import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.neighbour_pairs(table(spark, sf_dir, "conversations"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.digests(decontam.find_overlaps(documents, items))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.measured(html_text.extract(table(spark, sf_dir, "pages")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.assess(table(spark, sf_dir, "documents")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from an empty cache, so that every distinct text is encoded."""
    return token_counts.limits(token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.results(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_chat": op2_chat,
    "op3_sharding": op3_sharding,
    "op4_minhash": op4_minhash,
    "op5_decontam": op5_decontam,
    "op6_html": op6_html,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_secrets": op9_secrets,
    "op10_substrings": op10_substrings,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
