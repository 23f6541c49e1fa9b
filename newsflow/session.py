"""Session settings and the shared folder the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, so that feed times without a zone are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor reaches: the cluster's ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="newsflow-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from there; the files go when the session's JVM ends.

    A lost executor then costs a re-read, and rows that carry a position keep it.
    """
    return _written(df, df.write)


def cut_finely(df: DataFrame, rows: int) -> DataFrame:
    """:func:`cut` into files of at most ``rows`` rows.

    A task reads files up to ``spark.sql.files.maxPartitionBytes``, each counted with ``openCostInBytes`` besides: small
    files bound the rows of a task, also where these take few bytes.
    """
    return _written(df, df.write.option("maxRecordsPerFile", rows))


def _written(df: DataFrame, writer: DataFrameWriter) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    writer.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df``, computed once, to be broadcast only if it has at most ``rows`` rows."""
    df = cut(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
