"""The driver's tables, and small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of texts that go to a Python worker and that are read from a file at a time, unless the session
#: says otherwise. Texts are far longer than the rows that Spark's defaults of 10,000 and 4,096 are made for.
TEXT_BATCH_ROWS, TEXT_READ_ROWS = 1000, 256
_BATCH_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", TEXT_BATCH_ROWS),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", TEXT_READ_ROWS),
}


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to read texts and to hand them to Python in small batches."""
    conf = df.sparkSession.conf
    for name, (default, rows) in _BATCH_ROWS.items():
        if conf.get(name) == default:
            conf.set(name, str(rows))
    return df


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, so that no other column of ``docs`` can get in the way."""
    return small_batches(docs).select("doc_id", "text")


def plain_names(docs: DataFrame, *kept: str) -> DataFrame:
    """``docs`` with columns named by their places, but for those in ``kept``.

    So an operator's own names cannot clash with those of further columns; ``toDF`` gives the old
    names back.
    """
    lower = {c.lower(): c for c in kept}
    return docs.toDF(*[lower.get(c.lower(), f"column_{n}") for n, c in enumerate(docs.columns)])


def span_columns(kinds: list[str], found: str = "found", base: str = "base") -> list:
    """Digest columns over ``found``, an array of (kind, start, end, base) in result order."""
    line = "concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))"
    all_spans = F.expr(f"array_join(transform({found}, x -> {line}), ',')")
    base_spans = F.expr(f"array_join(transform(filter({found}, x -> x.{base}), x -> {line}), ',')")
    counts = [
        F.expr(f"cast(size(filter({found}, x -> x.{base} and x.kind = '{kind}')) as long)").alias(
            f"n_{kind}"
        )
        for kind in kinds
    ]
    return [
        *counts,
        F.sha2(base_spans.cast("binary"), 256).alias("base_sha256"),
        all_spans.alias("spans"),
    ]
