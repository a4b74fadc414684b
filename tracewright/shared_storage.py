"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[list[str] | None] = ContextVar("settled_folders", default=None)


def _root(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set: on {master} intermediate tables need a folder that all "
            "executors share."
        )
    root = tempfile.mkdtemp(prefix="tracewright-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession) -> str:
    """A new, unused path below the session's checkpoint folder."""
    path = f"{_root(spark).rstrip('/')}/tracewright/{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def settled(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that are settled inside the block at its end.

    The results of the block must have been written by then. Without a scope the folders stay and the
    cluster's retention removes them.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        folders = _SCOPE.get()
        _SCOPE.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside the block are removed as soon as a write has ended.

    Otherwise they stay until the driver happens to collect its garbage. A write has a plan of its own, so
    nothing else reads them.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a value must not change between two evaluations (row numbers, sampled range bounds):
    the written table survives the loss of executors and stays prunable by column.
    """
    path = shared_folder(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
