"""Token counts with a cache of counts by digest.

A count depends on the text, as the tokenizer sees it, and on the tokenizer alone. The cache is a folder
of Parquet files with a folder per tokenizer version and rows of a text's digest and its count. Counting a
table joins the digests of its distinct texts to the stored counts, gives only the misses to the library,
each once, and appends their counts before the result is read.

* Null counts as an empty text, and that is all that is normalised by default: byte-level vocabularies
  count every byte. ``normalise`` can be a column expression that leaves the counts as they are, so that
  more texts share a count.
* The tokenizer version is the SHA-256 of the file's bytes with the library's name and version. Another
  file or library finds no stored counts.
* Appending is safe at any time: a row is right on its own, a job that fails midway leaves at most counts
  that the next one need not compute, and two writers at once store the same counts twice, of which
  readers take one.
* Repeated rows give repeated results, an empty table an empty one. Other columns are ignored.
* Very long texts go to the library in parts, cut in front of a single space where the pattern of a
  byte-level vocabulary always begins a new piece; the count is the same. Without such a place, or with
  another kind of vocabulary, the text goes whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm.tables import texts
from pickwise.llm.words import row_blocks
from pickwise.operators.skew import hot_keys, split_join
from pickwise.workspace import materialize, scratch_path

#: Texts of more tokens than this are over the limit.
LIMIT = 1024
#: Characters that the library gets at a time.
PART_CHARS = 1 << 20
#: A place in front of which a byte-level vocabulary starts a piece whatever stands around.
_CUT = re.compile(r"(?<=\S)(?= \S)")


@functools.lru_cache(4)
def version(path: str) -> str:
    """Digest of a tokenizer: its file, the library that reads it and that library's version."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    digest = hashlib.sha256(f"{library.__name__} {library.__version__} ".encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


@functools.lru_cache(2)
def counter(path: str):
    """A function from a list of texts to their counts, by the library for the kind of file."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        import tokenizers

        encoder = tokenizers.Tokenizer.from_file(path)
        encoder.no_truncation()
        encoder.no_padding()
        in_parts = encoder.normalizer is None and _is_byte_level(encoder)

        def counts(batch: list[str]) -> list[int]:
            parts = [parted(text) if in_parts else [text] for text in batch]
            found = iter(
                encoder.encode_batch_fast([p for some in parts for p in some], add_special_tokens=False)
            )
            return [sum(len(next(found)) for _ in some) for some in parts]

        return counts
    if path.endswith(".model"):
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda batch: [
            len(ids) for ids in encoder.encode(batch, num_threads=1, add_bos=False, add_eos=False)
        ]
    raise ValueError(f"neither a .json nor a .model file: {path}")


def _is_byte_level(encoder) -> bool:
    import tokenizers

    return isinstance(encoder.pre_tokenizer, tokenizers.pre_tokenizers.ByteLevel) and not any(
        " " in token.content or token.lstrip or token.rstrip
        for token in encoder.get_added_tokens_decoder().values()
    )


def parted(text: str, most: int = PART_CHARS) -> list[str]:
    """Parts of about ``most`` characters that together have as many tokens as the text."""
    out, begin = [], 0
    while len(text) - begin > most:
        cut = _CUT.search(text, begin + most)
        if cut is None:
            break
        out.append(text[begin : cut.start()])
        begin = cut.start()
    return [*out, text[begin:]]


class CountCache:
    """Stored counts of one tokenizer in ``folder``, which all executors can reach."""

    def __init__(self, spark: SparkSession, folder: str, tokenizer: str):
        self.spark, self.tokenizer = spark, tokenizer
        self.folder = f"{folder.rstrip('/')}/version={version(tokenizer)}"

    def read(self) -> DataFrame:
        """``digest, n_tokens``, one row per text."""
        schema = "digest binary, n_tokens long"
        try:
            stored = self.spark.read.schema(schema).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], schema)
        return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame) -> None:
        counts.select("digest", "n_tokens").write.mode("append").parquet(self.folder)

    def misses(self, distinct: DataFrame) -> DataFrame:
        return distinct.join(self.read().select("digest"), "digest", "left_anti")


def encode(distinct: DataFrame, tokenizer: str) -> DataFrame:
    """``digest, n_tokens`` for rows of ``digest, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for batch in row_blocks(batches, "text"):
            found = counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(found, pa.int64())], ["digest", "n_tokens"]
            )

    return distinct.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: CountCache | str | None = None, normalise=lambda text: text
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; new texts are encoded at once and stored.

    ``cache`` is a ``CountCache`` or its folder; without one, counts are kept in a scratch folder.
    """
    spark = docs.sparkSession
    if not isinstance(cache, CountCache):
        cache = CountCache(spark, cache or scratch_path(spark, "counts"), tokenizer)
    seen: Column = normalise(F.coalesce("text", F.lit("")))
    # Digests of both kinds of string are those of its UTF-8 bytes.
    keyed = texts(docs).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(seen.cast("binary"), 256)).alias("digest"),
        seen.alias("text"),
    )
    # The copies of a text meet as one per task, and the texts are dealt out by digest only once.
    distinct = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    cache.append(encode(cache.misses(distinct), tokenizer))
    rows = materialize(keyed.select("doc_id", "n_bytes", "digest"), "digests")
    hot = hot_keys(rows.groupBy("digest").agg(F.count("*").alias("copies")), ["digest"], "copies")
    stored = cache.read().withColumnRenamed("digest", "stored")
    joined = split_join(rows, stored, ["digest"], ["stored"], "inner", hot)
    return joined.select("doc_id", "n_bytes", "n_tokens")


def limits(counted: DataFrame, limit: int = LIMIT) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
