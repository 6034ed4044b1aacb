"""Scratch tables in the folder that driver and executors share, and files through Hadoop's file systems."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[str]] = []
_LOCAL: list[str] = []
_FOLDERS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset: a temporary folder on a local master, whose executors are this
    process; an error on a cluster, whose executors do not share one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="rillsync-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return "file://" + _LOCAL[0]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application under shared_root(); it is deleted when the driver ends."""
    key = f"{spark.sparkContext.applicationId}:{shared_root(spark)}"
    if key not in _FOLDERS:
        folder = f"{shared_root(spark)}/rillsync-{uuid.uuid4().hex[:12]}"
        fs, at = hadoop_path(spark, folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: later stages do not compute it again, and a
    lost executor costs only its own tasks. Written, not cached, so it outlives any executor."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._scratch = path
    if _SCOPES:
        _SCOPES[-1].append(path)
    return back


def release(*frames: DataFrame) -> None:
    """Delete what materialize() wrote for these, once nothing reads them any more."""
    for df in frames:
        fs, at = hadoop_path(df.sparkSession, df._scratch)
        fs.delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What materialize() writes inside is deleted at the end, but for the tables that are passed to the function that
    this gives. Tables that are not written inside are not touched."""
    written: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._scratch)
        return df

    _SCOPES.append(written)
    try:
        yield keep
    finally:
        _SCOPES.remove(written)
        for path in written:
            if path not in kept:
                fs, at = hadoop_path(spark, path)
                fs.delete(at, True)
