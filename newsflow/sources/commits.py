"""Changes of a Parquet table in one step, and the index of its keys.

A change is staged beside the table: files to add, names of the files they replace, rows
for the index, and last a mark that all of it is there. Then files are moved and
deleted. A change that broke off before its mark is undone by the next one, one that broke off
after it is finished. Tables have one writer at a time.

The index lists every stored key, hash-bucketed by it. A batch looks its keys up without shuffling the
index: few keys read their buckets only, many are brought to the buckets' partitions. Keys that went are
marked as such by later rows; :func:`compact_index` drops both.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import cut

BUCKETS = 64
FEW = 1_000  # keys that are named in the filter of the index
_AT_ONCE = 16  # moves and deletions
_IDS, _JOURNAL, _LOADS, _DROPPED = "_ids", "_journal", "_loads", "_dropped"
_INDEX = "key STRING, time TIMESTAMP_NTZ, stored BOOLEAN, at BIGINT"


# -- files ---------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _path_class(jvm):
    return jvm.org.apache.hadoop.fs.Path


def _path(spark: SparkSession, path: str):
    jvm_path = _path_class(spark._jvm)(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _path(spark, path)
    return fs.exists(jvm_path)


def _names(spark: SparkSession, folder: str, below: str) -> list[str]:
    """What matches the pattern ``below`` in a folder, relative to it.

    The paths come over in one string, as a job's list of inputs: tables may have a folder for each of many dates.
    """
    fs, jvm_path = _path(spark, folder)
    root = fs.makeQualified(jvm_path).toString().rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop
    found = fs.globStatus(_path_class(spark._jvm)(re.sub(r"([\[\]{}*?\\])", r"\\\1", root) + "/" + below))
    if not found:
        return []
    job = hadoop.mapred.JobConf(False)
    hadoop.mapred.FileInputFormat.setInputPaths(job, hadoop.fs.FileUtil.stat2Paths(found))
    paths = re.split(r"(?<!\\),", job.getRaw("mapreduce.input.fileinputformat.inputdir"))
    return [re.sub(r"\\(.)", r"\1", p).removeprefix(root + "/") for p in paths]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing if there is none."""
    return sorted(_names(spark, path, "*"))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files of rows in a folder and in its folders of a partition column, relative to it."""
    found = [n for n in _names(spark, path, "*") if "=" not in n] + _names(spark, path, "*=*/*")
    return sorted(name for name in found if not any(part[0] in "_." for part in name.split("/")))


def _each(run: Callable[[str], None], names: Iterable[str]) -> None:
    """``run`` for all names, some at a time; the first failure is raised."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(run, names))


def remove(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _path(spark, path)
    fs.delete(jvm_path, True)


def _touch(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _path(spark, path)
    fs.create(jvm_path, True).close()


def _move_in(spark: SparkSession, source: str, target: str) -> None:
    """Move all data files, in whole folders where the target has none of that name; those that were moved before are gone from ``source``."""
    names = data_files(spark, source)
    if not names:
        return
    fs, jvm_path = _path(spark, target)
    fs.mkdirs(jvm_path)
    there = set(children(spark, target))
    top = {n: n.split("/")[0] for n in names}

    def move(name: str) -> None:
        if not fs.rename(_path(spark, f"{source}/{name}")[1], _path(spark, f"{target}/{name}")[1]):
            raise OSError(f"{name} could not be moved to {target}")

    _each(move, sorted({n if top[n] in there else top[n] for n in names}))


# -- changes -------------------------------------------------------------------------------


def change(
    spark: SparkSession, path: str, rows: DataFrame | None = None, by: tuple[str, ...] = (), replaces: list[str] = (), ids: DataFrame | None = None, load: str | None = None
) -> int:
    """Add ``rows``, partitioned by ``by``, in place of the files ``replaces`` (relative to ``path``).

    ``ids`` are rows for the index: ``key, time, stored``; a function of the added rows may be given instead.
    ``load`` names the change, for :func:`loaded`. Returns the number of rows written.
    """
    recover(spark, path)
    n = 0
    stage = f"{path}/{_JOURNAL}/{load or uuid.uuid4().hex}"
    if rows is not None:
        rows.write.partitionBy(*by).parquet(f"{stage}/rows")
        written = spark.read.schema(rows.schema).parquet(f"{stage}/rows")
        n = written.count()  # from the files' footers
        ids = ids(written) if callable(ids) else ids
    if ids is not None:
        _write_ids(ids.withColumn("at", F.lit(time.time_ns())), f"{stage}/ids")
    if replaces:
        spark.createDataFrame([(f,) for f in replaces], "file string").coalesce(1).write.text(f"{stage}/old")
    _touch(spark, f"{stage}/READY")
    _finish(spark, path, stage)
    return n


def _finish(spark: SparkSession, path: str, stage: str) -> None:
    if exists(spark, f"{stage}/old"):
        old = [row.value for row in spark.read.text(f"{stage}/old").toLocalIterator()]  # the caller had the list
        _each(lambda name: remove(spark, f"{path}/{name}"), old)
    _move_in(spark, f"{stage}/rows", path)
    _move_in(spark, f"{stage}/ids", f"{path}/{_IDS}")
    name = stage.rsplit("/", 1)[1]
    _touch(spark, f"{path}/{_LOADS}/{name}")
    remove(spark, stage)


def recover(spark: SparkSession, path: str) -> None:
    """Finish the changes that were staged as a whole, undo the others."""
    for name in children(spark, f"{path}/{_JOURNAL}"):
        stage = f"{path}/{_JOURNAL}/{name}"
        if exists(spark, f"{stage}/READY"):
            _finish(spark, path, stage)
        else:
            remove(spark, stage)


def loaded(spark: SparkSession, path: str, load: str) -> bool:
    """Whether the change of this name is in the table."""
    recover(spark, path)
    return exists(spark, f"{path}/{_LOADS}/{load}")


# -- index ---------------------------------------------------------------------------------


def _write_ids(ids: DataFrame, folder: str) -> None:
    bucketed(ids.select("key", "time", "stored", "at"), folder, "key", BUCKETS)


def bucketed(df: DataFrame, folder: str, key: str, buckets: int) -> DataFrame:
    """``df`` written to ``folder`` in hash buckets of ``key``, and read in their partitions."""
    spark, name = df.sparkSession, f"newsflow_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.format("parquet").option("path", folder).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay


def index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the index, in the partitions of its buckets."""
    name = f"newsflow_ids_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({_INDEX}) USING parquet CLUSTERED BY (key) INTO {BUCKETS} BUCKETS LOCATION '{path}/{_IDS}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def stored_among(keys: DataFrame, path: str) -> DataFrame:
    """Those of a narrow table of distinct ``key`` s that the table at ``path`` holds."""
    spark = keys.sparkSession
    ids = index(spark, path)
    wanted = [r.key for r in keys.limit(FEW + 1).collect()]
    found = ids.where(F.col("key").isin(wanted)) if len(wanted) <= FEW else keys.repartition(BUCKETS, "key").join(ids, "key")
    return _latest(found, spark, path).select("key")


def _latest(ids: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    last = F.max_by(F.struct("stored", "time", "at"), "at").alias("last")
    return ids.groupBy("key").agg(last).select("key", "last.*").where(F.col("stored") & ~_dropped(spark, path))


def _dropped(spark: SparkSession, path: str) -> Column:
    """Index rows whose table rows retention dropped after they were written: one condition per cutoff kept."""
    gone = F.lit(False)
    for name in children(spark, f"{path}/{_DROPPED}"):
        cutoff, at = map(int, name.split("-"))
        gone = gone | (F.coalesce(F.unix_micros(F.col("time").cast("timestamp")) < cutoff, F.lit(False)) & (F.col("at") < at))
    return gone


def note_dropped(spark: SparkSession, path: str, cutoff: int) -> None:
    """Rows of times before ``cutoff`` (microseconds) are about to go; earlier notes of no later cutoff are void."""
    for name in children(spark, f"{path}/{_DROPPED}"):
        if int(name.split("-")[0]) <= cutoff:
            remove(spark, f"{path}/{_DROPPED}/{name}")
    _touch(spark, f"{path}/{_DROPPED}/{cutoff}-{time.time_ns()}")


def batch_keys(batch: DataFrame, key: str) -> DataFrame:
    """``key, n``: the keys of a batch and their rows, written once."""
    return cut(batch.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")))


def not_stored(batch: DataFrame, path: str, key: str, stored: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Rows of a batch whose key the table at ``path`` does not hold.

    A table written without an index gets one first, from its ``stored`` rows (``key, time``). ``keys``
    are :func:`batch_keys` if the caller has them.
    """
    spark = batch.sparkSession
    recover(spark, path)
    if not exists(spark, f"{path}/{_IDS}"):
        if stored is None or not data_files(spark, path):
            return batch
        change(spark, path, ids=stored.withColumn("stored", F.lit(True)))
    keys = batch_keys(batch, key) if keys is None else keys
    found = stored_among(keys.select("key"), path).select(F.col("key").alias("_stored"))
    return batch.join(found, F.col(key).cast("string") == F.col("_stored"), "left_anti")


def compact_index(spark: SparkSession, path: str) -> None:
    """Write the index anew: one row per stored key, one file per bucket."""
    recover(spark, path)
    if not exists(spark, f"{path}/{_IDS}"):
        return
    old = [f"{_IDS}/{f}" for f in data_files(spark, f"{path}/{_IDS}")]
    change(spark, path, ids=_latest(index(spark, path), spark, path).select("key", "time", "stored"), replaces=old)
