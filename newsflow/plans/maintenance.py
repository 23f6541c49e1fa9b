"""The weekly job: drop what is too old from the store, then report what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.fields import micros
from newsflow.sources import store


def weekly_maintenance(spark: SparkSession, path: str, cutoff: Column) -> DataFrame:
    """Retention in place, and statistics of what the store then holds: ``metric, value``."""
    deleted = store.retention_report(store.read_articles(spark, path), cutoff).first().deleted
    store.apply_retention(spark, path, cutoff)
    measures = {
        "deleted": F.lit(deleted),
        "kept": F.count("*"),
        "sources": F.count_distinct("source"),
        "earliest_epoch_s": F.floor(F.min(micros(F.col("published_at"))) / 1_000_000),
        "latest_epoch_s": F.floor(F.max(micros(F.col("published_at"))) / 1_000_000),
    }
    row = store.read_articles(spark, path).agg(*[m.cast("bigint").alias(name) for name, m in measures.items()])
    return row.unpivot([], list(measures), "metric", "value")
