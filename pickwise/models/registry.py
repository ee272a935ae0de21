"""Model versions and training history as append-only tables.

A version row holds the dense layers as bytes; its vectors stay a table next to it, named by
``embeddings_path``, and ``maps_version`` says which vocabularies the ids belong to.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.models.network import Network
from pickwise.models.training import TrainedModel
from pickwise.operators.ordering import latest_row
from pickwise.schemas import HISTORY, MODEL_VERSIONS
from pickwise.sources.tables import append_collection, read_collection
from pickwise.workspace import claim_number


def next_version(versions: DataFrame) -> DataFrame:
    """One row: the version after the newest entry (by time), 0 for an empty registry."""
    return versions.agg(
        F.coalesce(F.max_by("version", "timestamp") + 1, F.lit(0)).cast("int").alias("next_version")
    )


def latest_version(versions: DataFrame) -> DataFrame:
    return latest_row(versions, "timestamp", "version")


def last_registered(versions: DataFrame) -> DataFrame:
    """The entry with the highest version number."""
    entry = F.struct(*versions.columns)
    return versions.agg(F.max_by(entry, F.col("version")).alias("last")).select("last.*")


def current_version(versions: DataFrame) -> DataFrame:
    return latest_version(versions).select("model", "timestamp", "version")


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> DataFrame:
        return read_collection(self.spark, f"{self.path}/model_versions", MODEL_VERSIONS)

    def history(self) -> DataFrame:
        return read_collection(self.spark, f"{self.path}/history", HISTORY)

    def register(
        self, model: TrainedModel, maps_version: str, moment: dt.datetime | None = None,
        source: str | None = None,
    ) -> int:
        """Store vectors first, then the version row, so a listed version is always complete.

        Vectors have a folder of their own whatever the version. The number follows the largest one
        listed, whatever the times say, and is claimed before it is used, so that two writers get
        two numbers; a writer that stops in between leaves a gap. ``source`` says what the model
        was made from; ``registered`` finds it again.
        """
        moment = moment or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        largest = self.versions().agg(F.max("version")).head()[0]
        version = claim_number(self.spark, f"{self.path}/claims", 0 if largest is None else largest + 1)
        vectors = f"{self.path}/embeddings/{uuid.uuid4().hex}"
        model.embeddings.write.partitionBy("feature").parquet(vectors)
        row = (model.name, _utc(moment), model.network.to_bytes(), version, maps_version, vectors, source)
        append_collection(
            self.spark.createDataFrame([row], MODEL_VERSIONS), f"{self.path}/model_versions"
        )
        if model.history:
            append_collection(
                history_rows(self.spark, model, moment), f"{self.path}/history"
            )
        return version

    def registered(self, source: str) -> int | None:
        """The version made from ``source``, None if there is none."""
        found = self.versions().filter(F.col("source") == source).select("version").head()
        return found["version"] if found else None

    def load(self) -> tuple[Network, DataFrame, str]:
        """Newest model: its layers, its vectors and the version of its vocabularies."""
        entry = latest_version(self.versions()).head()
        if entry is None:
            raise ValueError("no model registered")
        vectors = self.spark.read.schema("feature string, idx int, vector array<float>").parquet(
            entry["embeddings_path"]
        )
        return Network.from_bytes(entry["binary"]), vectors, entry["maps_version"]


def _utc(moment: dt.datetime) -> dt.datetime:
    """A time without zone is UTC, whatever the machine's zone."""
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def history_rows(spark: SparkSession, model: TrainedModel, moment: dt.datetime) -> DataFrame:
    """Metrics per epoch under a run id made of the model name and the time."""
    run = f"{model.name}/{moment:%Y-%m-%d_%H-%M-%S}"
    rows = [(run, *[entry[c] for c in HISTORY.names[1:]]) for entry in model.history]
    return spark.createDataFrame(rows, HISTORY)
