"""Intermediate tables in the folder the cluster shares.

A staged table cuts lineage and pins values that must not change when a lost task
runs again. The folder is the one the session names for checkpoints: its
``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` was given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from threading import Lock, local

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Stored tables are mostly texts that repeat in parts, which this codec makes far smaller than the default.
SMALL = ("compression", "zstd")
#: Bytes of file lists that Spark keeps in the driver for the life of the application; 0 keeps none.
KEPT_LISTS = "spark.sql.hive.filesourcePartitionFileCacheSize"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a session that names none is refused."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return folder.rstrip("/")


def staging_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/lamina/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the staging folder that nothing has written yet."""
    return f"{staging_folder(spark)}/{label}-{uuid.uuid4().hex}"


_scopes = local()


@contextmanager
def noting_staged() -> Iterator[list[str]]:
    """The paths that this thread stages while the block runs, for release when they are read.

    A block inside another notes its own paths only.
    """
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = []
    try:
        yield _scopes.paths
    finally:
        _scopes.paths = outer


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path that the innermost ``noting_staged`` block of this thread gets to know."""
    path = new_path(spark, label)
    noted = getattr(_scopes, "paths", None)
    if noted is not None:
        noted.append(path)
    return path


_options: dict[tuple[SparkSession, str], tuple[int, str | None]] = {}
_changing = Lock()


@contextmanager
def session_option(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """An option that holds while the block runs, in any of several threads.

    It belongs to the session: the last of the threads to leave puts it back.
    """
    slot = (spark, name)
    with _changing:
        users, before = _options.get(slot, (0, None))
        if not users:
            before = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _options[slot] = users + 1, before
    try:
        yield
    finally:
        with _changing:
            users, before = _options.pop(slot)
            if users > 1:
                _options[slot] = users - 1, before
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan of a Parquet table of known layout, whose file list goes with the scan.

    Spark would keep the list of every path that was ever read, up to 250 MB of the driver's memory,
    although a stored table has a path of its own and its plans hold the list while they are needed.
    """
    with session_option(spark, KEPT_LISTS, "0"):
        return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to a fresh staged table and read them back."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.option(*SMALL).parquet(path)
    return scan(spark, path, df.schema)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a stored table, asked of its file system in one call."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared store.

    Spark's Python API has no call for it, so this asks the Hadoop file system that Spark's own
    readers and writers use for the path.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(folder, True)


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        delete(spark, path)


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage once the plans of a finished table are dropped.

    Spark deletes the shuffles and broadcasts of a plan only then, and the heap, which grows while
    plans are made, goes back to what is still in use. Otherwise both wait until the heap is full.
    """
    spark.sparkContext._jvm.System.gc()


def release_staging(spark: SparkSession) -> bool:
    """Delete this application's staged tables once nothing reads them any more."""
    return delete(spark, staging_folder(spark))
