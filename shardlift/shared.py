"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}
_RUNS: list[SharedRun] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, else the one given to `setCheckpointDir`.

    Only where neither is set and everything runs in one process, as in tests, it is a new local folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(f"{_SETTING} has to name a folder that all executors share")
        app = context.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        folder = _LOCAL[app]
    return folder.rstrip("/")


class SharedRun:
    """Tables written while it is open lie in one folder, which `close` deletes when they are not needed any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> SharedRun:
        _RUNS.append(self)
        return self

    def __exit__(self, *_: object) -> None:
        _RUNS.remove(self)

    def close(self) -> None:
        delete_folder(self.spark, self.folder)


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, with Spark's own settings."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop(spark, folder)
    files.delete(path, True)


def shared_name(spark: SparkSession, path: str) -> str:
    """The absolute form of a path, as tasks have to know it; local ones without a scheme."""
    found, files = _hadoop(spark, path)
    name = files.makeQualified(found).toString()
    return re.sub(r"^file:/+", "/", name)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Spark the real size of the table
    for its choice of joins.
    """
    spark = df.sparkSession
    folder = _RUNS[-1].folder if _RUNS else shared_folder(spark)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
