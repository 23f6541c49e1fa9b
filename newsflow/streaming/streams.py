"""Feeds as streams. Event time is ``TIMESTAMP``, read in a UTC session."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators.dedup import keep_first
from newsflow.session import scratch_path
from newsflow.sources import commits

LATENESS = "1 hour"
POLL = "5 minutes"


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The table ``name`` of a folder as a stream, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jvm_path).isDirectory()
    reader = spark.readStream.schema(schema)
    return reader.parquet(path) if is_folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def with_event_time(stream: DataFrame, time: str, lateness: str = LATENESS) -> DataFrame:
    """``time`` as the event time, with a watermark ``lateness`` behind the newest row."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)


def sliding_counts(stream: DataFrame, time: str, *by: str | Column) -> DataFrame:
    """Rows of the last hour, every five minutes."""
    return stream.groupBy(F.window(time, "1 hour", POLL), *by).agg(F.count("*").alias("n"))


def daily_counts(stream: DataFrame, time: str, *by: str | Column) -> DataFrame:
    return stream.groupBy(F.window(time, "1 day"), *by).agg(F.count("*").alias("n"))


def hourly_counts(stream: DataFrame, time: str, *by: str | Column) -> DataFrame:
    """Rows per hour. Rows of an hour the watermark has closed are dropped."""
    return stream.groupBy(F.window(time, "1 hour"), *by).agg(F.count("*").alias("n"))


def start(stream: DataFrame, path: str, checkpoint: str, every: str = POLL, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Continuous load into a table: a batch ``every`` so often, restartable from its checkpoint."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(processingTime=every).start()


def poll(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Load all that has arrived since the last poll, then stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def loaded(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all that is there, into a scratch table; returns the table."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    poll(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def each_batch(stream: DataFrame, put, checkpoint: str, every: str | None, mode: str = "append") -> StreamingQuery:
    """Run ``put(batch, number)`` for what is there, then stop; with ``every``, a batch so often."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(put)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def put_new(
    rows: DataFrame, path: str, key: str, *order: str | Column, stored: str | None = None, partition_by: tuple[str, ...] = (), load: str | None = None
) -> int:
    """Append the first row of each key that neither the table at ``path`` nor the one at ``stored`` holds, by their indexes."""
    spark, schema = rows.sparkSession, rows.schema
    rows = keep_first(rows, key, *order)
    for table in (path, stored):
        if table is not None and commits.data_files(spark, table):
            rows = commits.not_stored(rows, table, key, _keys(spark.read.parquet(table) if table == stored else spark.read.schema(schema).parquet(table), key))
    return commits.change(spark, path, rows, partition_by, ids=lambda new: _keys(new, key).withColumn("stored", F.lit(True)), load=load)


def _keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), F.lit(None).cast("timestamp_ntz").alias("time"))


def store_new(
    stream: DataFrame, path: str, checkpoint: str, key: str, *order: str | Column, stored: str | None = None,
    partition_by: tuple[str, ...] = (), every: str | None = None,
) -> StreamingQuery:
    """:func:`put_new` for each batch, however late its rows come.

    No watermark decides what is stored, so the keys do not depend on how the input is
    cut into batches. A batch of a number that is stored is not stored again; one that broke off while it
    was written is finished or undone first. A stream without rows leaves an empty table.
    """
    spark = stream.sparkSession
    name = _stream_name(checkpoint)

    def put(batch: DataFrame, number: int) -> None:
        load = f"{name}-{number}"
        if not commits.loaded(batch.sparkSession, path, load):
            put_new(batch, path, key, *order, stored=stored, partition_by=partition_by, load=load)

    if not commits.data_files(spark, path):
        spark.createDataFrame([], stream.schema).write.mode("append").parquet(path)
    return each_batch(stream, put, checkpoint, every)


def _stream_name(checkpoint: str) -> str:
    """A name for the batches of one checkpoint."""
    return f"stream-{zlib.crc32(checkpoint.encode()):08x}"


def loaded_new(stream: DataFrame, name: str, key: str, *order: str | Column, stored: str | None = None) -> DataFrame:
    """:func:`store_new` over all that is there, into a scratch table; returns the table."""
    path = scratch_path(stream.sparkSession, name)
    store_new(stream, f"{path}/table", f"{path}/checkpoint", key, *order, stored=stored)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/table")


def upsert_counts(counts: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the last ``n`` of each group of a counting stream in a table: windows that are open are there too.

    Each batch appends the groups it changed, with its number; see :func:`read_counts`. Nothing passes through the driver.
    """
    name = _stream_name(checkpoint)

    def put(batch: DataFrame, number: int) -> None:
        load = f"{name}-{number}"
        if not commits.loaded(batch.sparkSession, path, load):
            commits.change(batch.sparkSession, path, batch.withColumn("_batch", F.lit(number).cast("long")), load=load)
        if number % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact_counts(batch.sparkSession, path, counts.schema)

    return each_batch(counts, put, checkpoint, every, "update")


COMPACT_EVERY = 100  # batches


def _last_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    keys = [c for c in schema.names if c != "n"]
    if not commits.data_files(spark, path):
        return spark.createDataFrame([], schema.add("_batch", "long"))
    changes = spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])).parquet(path)
    return changes.groupBy(*keys).agg(F.max_by("n", "_batch").alias("n"), F.max("_batch").alias("_batch"))


def read_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last value of ``n`` for each group of :func:`upsert_counts`."""
    commits.recover(spark, path)
    return _last_counts(spark, path, schema).select(*schema.names)


def compact_counts(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Write a table of :func:`upsert_counts` anew, without the values that later ones replaced."""
    old = commits.data_files(spark, path)
    commits.change(spark, path, _last_counts(spark, path, schema).select(*schema.names, "_batch"), replaces=old)


def latest_counts(counts: DataFrame, name: str) -> DataFrame:
    """The last value of ``n`` for each group of a counting stream, open windows included."""
    path = scratch_path(counts.sparkSession, name)
    upsert_counts(counts, f"{path}/table", f"{path}/checkpoint")
    return read_counts(counts.sparkSession, f"{path}/table", counts.schema)


def running_totals(stream: DataFrame, by: str, name: str) -> DataFrame:
    """Running counts per ``by``, as of all rows that are there."""
    return latest_counts(stream.groupBy(by).agg(F.count("*").alias("n")), name)
