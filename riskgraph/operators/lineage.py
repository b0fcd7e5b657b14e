"""Cutting lineage: intermediate tables that later steps read instead of recomputing.

A cut is a Parquet table in the shared folder the cluster names in ``spark.checkpoint.dir``. Its files survive the
loss of executors, later readers prune its columns, and its size is known to the optimizer.
"""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The configured folder; where none is set, one in the warehouse, which every node reaches too."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_cuts"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed with the tables of this application."""
    _owned.add(spark.sparkContext.applicationId)
    return f"{shared_folder(spark)}/riskgraph/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


_owned: set[str] = set()


class _Open(threading.local):
    """The scopes that are open in this thread, each with the paths it removes at its end and those it leaves."""

    def __init__(self) -> None:
        self.scopes: list[tuple[list[str], list[str], bool]] = []


_open = _Open()


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Remove every table this application has cut. Frames that read one of them cannot be used any more."""
    _remove(spark, f"{shared_folder(spark)}/riskgraph/{spark.sparkContext.applicationId}")
    _owned.discard(spark.sparkContext.applicationId)


@contextmanager
def scope(spark: SparkSession, around: bool = False) -> Iterator[list[str]]:
    """Remove the cuts made inside as soon as it ends, but for ``lasting`` ones, whose paths it gives to its user.

    An operator whose steps all run inside needs the disk of its intermediate tables only while it works; what its
    result still reads is cut as ``lasting``. What lasts beyond an inner scope goes with the outer one, unless that is
    ``around`` whole operators and hands on their lazy results.
    """
    passing, lasting = [], []
    _open.scopes.append((passing, lasting, around))
    try:
        yield lasting
    finally:
        _open.scopes.pop()
        for path in passing:
            _remove(spark, path)
        if _open.scopes:
            _open.scopes[-1][_open.scopes[-1][2]].extend(lasting)


def discard(spark: SparkSession, paths: Iterable[str], unless_read_by: DataFrame) -> None:
    """Remove lasting cuts, but for those that ``unless_read_by`` reads."""
    read = unless_read_by.inputFiles()
    for path in paths:
        if not any(path.split("/riskgraph/", 1)[1] in file for file in read):
            _remove(spark, path)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _owned else None
    if spark is not None and spark.sparkContext.applicationId in _owned:
        release(spark)


def cut(df: DataFrame, partition_by: str | None = None, lasting: bool = False, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once and read it back; with ``partition_by``, one folder per value of that column.

    Inside a ``scope`` the table goes with it, unless it is ``lasting``. Large tables of hashes as text take half the disk
    with the ``codec`` zstd.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    if _open.scopes:
        _open.scopes[-1][lasting].append(path)
    if partition_by:
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path, compression=codec)
    else:
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
