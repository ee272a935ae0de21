"""Parquet tables: collections, vocabularies and the keyed recommendation table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickwise.functions.scalars import join_list
from pickwise.schemas import COMPACTIONS, FEATURE_MAP, KEYED_ROWS, RUNS
from pickwise.workspace import delete_folder


def read_collection(
    spark: SparkSession, path: str, schema: StructType, required: bool = False
) -> DataFrame:
    """A whole collection without its storage id; an absent one is empty unless ``required``."""
    try:
        return spark.read.schema(schema).parquet(path).drop("_id")
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_collection(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_feature_maps(feature_maps: DataFrame, path: str, maps_version: str) -> None:
    """Store the vocabularies of one version; a feature is a folder, so reads prune to it."""
    feature_maps.write.mode("overwrite").partitionBy("feature").parquet(
        f"{path}/maps_version={maps_version}"
    )


def read_feature_maps(spark: SparkSession, path: str, maps_version: str) -> DataFrame:
    return (
        spark.read.schema(FEATURE_MAP)
        .parquet(f"{path}/maps_version={maps_version}")
        .select("feature", "value", "idx")
    )


def latest_per_key(rows: DataFrame, order: Sequence[str] = ("batch_id",)) -> DataFrame:
    """(user_id, recommendations, *order) to the newest row per key by ``order``.

    A plain aggregate: partial maxima are taken before the shuffle, so a key with very many
    versions costs one row per task.
    """
    newest = F.max(F.struct(*order, "recommendations"))
    return (
        rows.groupBy("user_id")
        .agg(newest.alias("newest"))
        .select("user_id", "newest.recommendations", *[f"newest.{c}" for c in order])
    )


def keyed_rows(lists: DataFrame, batch_id: int) -> DataFrame:
    """Recommendation lists as (user_id, recommendations, batch_id) rows."""
    return lists.select(
        "user_id",
        join_list(F.col("top_k_asins")).alias("recommendations"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )


class KeyedTable:
    """Last write wins per user, kept as one folder per batch of a run.

    Batch numbers start anew with every stream checkpoint, so they count within a run only; a run
    is named by who writes (a stream's checkpoint) and later runs win over earlier ones. Writing a
    batch costs the size of the batch, whatever the size of the table. Replaying a batch replaces
    its folder, so the table is the same after any number of attempts. A reader takes the newest
    row per key. ``compact`` writes that view next to the batches and then lists it, so readers
    either see it whole or not at all; the batches it holds are deleted by the compaction after it,
    when no reader can still need them. One process opens runs and compacts at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._runs: dict[str, int] = {}

    def run_number(self, name: str) -> int:
        """The place of the run among all runs; a new name becomes the last one."""
        if name not in self._runs:
            known = read_collection(self.spark, f"{self.path}/runs", RUNS)
            row = known.agg(
                F.max(F.when(F.col("name") == name, F.col("run"))).alias("mine"), F.max("run").alias("last")
            ).head()
            if row["mine"] is None:
                number = 0 if row["last"] is None else row["last"] + 1
                append_collection(
                    self.spark.createDataFrame([(name, number)], RUNS), f"{self.path}/runs"
                )
            else:
                number = row["mine"]
            self._runs[name] = number
        return self._runs[name]

    def upsert(self, rows: DataFrame, batch_id: int, run: str = "") -> None:
        rows.select("user_id", "recommendations").write.mode("overwrite").parquet(
            f"{self.path}/data/run={self.run_number(run)}/batch_id={int(batch_id)}"
        )

    def _compactions(self) -> list:
        listed = read_collection(self.spark, f"{self.path}/compactions", COMPACTIONS)
        return listed.orderBy(F.desc("number")).limit(2).collect()

    def _rows(self) -> DataFrame:
        fresh = read_collection(self.spark, f"{self.path}/data", KEYED_ROWS)
        newest = self._compactions()[:1]
        if not newest:
            return fresh
        for upto in newest[0]["covered"]:
            fresh = fresh.filter((F.col("run") != upto["run"]) | (F.col("batch_id") > upto["batch_id"]))
        kept = self.spark.read.schema(KEYED_ROWS).parquet(newest[0]["folder"])
        return kept.unionByName(fresh)

    def _latest(self) -> DataFrame:
        return latest_per_key(self._rows(), ("run", "batch_id"))

    def read(self) -> DataFrame:
        return self._latest().select("user_id", "recommendations", "batch_id")

    def compact(self) -> None:
        """Write the current view, list it, delete the batches that the one before it holds."""
        before = self._compactions()
        data = read_collection(self.spark, f"{self.path}/data", KEYED_ROWS)
        # One row per run that has batches.
        upto = data.groupBy("run").agg(F.max("batch_id").alias("batch_id")).collect()
        covered = {r["run"]: r["batch_id"] for r in upto}
        for old in before[0]["covered"] if before else []:
            covered[old["run"]] = max(covered.get(old["run"], -1), old["batch_id"])
        number = before[0]["number"] + 1 if before else 0
        folder = f"{self.path}/compacted/number={number}-{uuid.uuid4().hex}"
        self._latest().select(*KEYED_ROWS.names).write.parquet(folder)
        row = (number, folder, sorted(covered.items()))
        append_collection(
            self.spark.createDataFrame([row], COMPACTIONS), f"{self.path}/compactions"
        )
        if before:
            held = {r["run"]: r["batch_id"] for r in before[0]["covered"]}
            present = data.select("run", "batch_id").distinct().collect()
            for r in present:
                if r["batch_id"] <= held.get(r["run"], -1):
                    delete_folder(self.spark, f"{self.path}/data/run={r['run']}/batch_id={r['batch_id']}")
        if len(before) > 1:
            delete_folder(self.spark, before[1]["folder"])


def write_partitions(lists: DataFrame, writer: Callable[[Iterable[Row]], None]) -> None:
    """Hand each partition of recommendation lists to ``writer``, e.g. a key-value client."""
    lists.foreachPartition(writer)
