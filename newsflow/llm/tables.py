"""Intermediate tables in the shared folder, and row identities."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps start from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def forget(*kept: DataFrame) -> None:
    """Delete the files of tables from :func:`keep` that no later step reads."""
    for df in kept:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let each finished job drop its shuffle files, so that disk holds one step at a time."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Let Python tasks of this session take Arrow batches of about ``size``, unless the user set a size."""
    if spark.conf.get(_BATCH, None) in (None, "-1"):
        spark.conf.set(_BATCH, size)


def rest(df: DataFrame, *names: str) -> list[Column]:
    """Columns of ``df`` other than ``names``."""
    return [F.col(f"`{c}`") for c in df.columns if c not in names]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
