"""Scratch tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for scratch tables of this application, shared by all executors.

    Only a local master without the setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="pickwise-"))
    return f"{root.rstrip('/')}/pickwise-{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shared_folder(spark: SparkSession, label: str):
    """A new scratch folder as a plain path while the scope lasts; None if only Spark's readers reach it."""
    context, folder = spark.sparkContext, scratch_path(spark, label)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(context._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        yield None
        return
    try:
        yield path.toUri().getPath()
    finally:
        delete_folder(spark, folder)


def claim_number(spark: SparkSession, folder: str, first: int) -> int:
    """The first number from ``first`` on that nobody has claimed in ``folder``, claimed.

    A claim is an empty file that is created only if it is not there, which shared file systems do as one
    step; whoever comes second takes the next number. Spark's local file system looks first and creates then,
    so there the file is created by the operating system.
    """
    context, number = spark.sparkContext, first
    jvm = context._jvm
    parent = jvm.org.apache.hadoop.fs.Path(folder)
    system = parent.getFileSystem(context._jsc.hadoopConfiguration())
    local = system.getUri().getScheme() == "file"
    if local:
        system.mkdirs(parent)
    while True:
        path = jvm.org.apache.hadoop.fs.Path(parent, str(number))
        if local:
            if jvm.java.io.File(path.toUri().getPath()).createNewFile():
                return number
        else:
            try:
                system.create(path, False).close()
                return number
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                    raise
        number += 1


_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables that ``materialize`` writes inside, all but those given to ``keep``.

    For work that repeats (a micro-batch, an epoch) and is finished when the scope ends. Scopes
    nest; a kept table belongs to the scope around.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    kept: set[str] = set()

    def keep(*tables: DataFrame) -> None:
        for table in tables:
            kept.update(path for path in paths if any(f.startswith(path) for f in _files(table)))

    try:
        yield keep
    finally:
        _open_scopes.remove(paths)
        for path in paths:
            if path not in kept:
                delete_folder(spark, path)
            elif _open_scopes:
                _open_scopes[-1].append(path)


def _files(table: DataFrame) -> list[str]:
    """The files a table reads, as plain paths."""
    return [re.sub("^file:/+", "/", name) for name in table.inputFiles()]


def materialize(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` once as a table and read it back: cuts lineage, survives lost executors.

    With columns ``by`` there is a folder for each of their values, and filters on them read no other.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*by).parquet(path)
    if _open_scopes:
        _open_scopes[-1].append(re.sub("^file:/+", "/", path))
    return spark.read.schema(df.schema).parquet(path)


def folders(table: DataFrame) -> list[str]:
    """The folders a table reads."""
    return sorted({name.rpartition("/")[0] for name in table.inputFiles()})


def release(table: DataFrame) -> None:
    """Delete the folder of a table that ``materialize`` gave."""
    for folder in folders(table):
        delete_folder(table.sparkSession, folder)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete every scratch table this application wrote."""
    return delete_folder(spark, scratch_root(spark))
