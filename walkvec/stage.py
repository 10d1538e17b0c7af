"""Intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage and survives the loss of any executor. Unlike a
checkpointed RDD it is columnar, so later steps read only the columns they use.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []


def stage_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, else one in the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stage"


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the stage root."""
    app = spark.sparkContext.applicationId
    path = f"{stage_root(spark)}/walkvec-{app}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back.

    The shuffle files of the writing go when it ends: nothing reads them again, and else
    they lie on the disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stage`` or ``stage_path`` named."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(rows: DataFrame) -> None:
    """Delete the staged table that ``rows`` reads, and which nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
        remove(rows.sparkSession, folder)


def last_staged(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, which must read the table it stages last only: those staged on the way go."""
    own: list[str] = []
    _scopes.append(own)
    try:
        rows = make()
    finally:
        _scopes.pop()
    for path in own[:-1]:
        remove(spark, path)
    return rows


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every table staged inside; for jobs that write their results."""
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.pop()
        for path in own:
            remove(spark, path)
