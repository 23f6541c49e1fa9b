"""Exact duplicates, seen rows and the window of earlier articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.fields import micros
from newsflow.operators.ordered import last_before, running_totals


def keep_first(df: DataFrame, key: list[str] | str, *order: Column | str) -> DataFrame:
    """One row per key, the first in ``order``; ties go to the smallest row hash.

    Spark limits each key to one row before the shuffle, so a key with very
    many copies sends one row per input partition.
    """
    keys = [key] if isinstance(key, str) else key
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in hashed])))
    return df.withColumn("_rn", first).where(F.col("_rn") == 1).drop("_rn")


def exclude_seen(df: DataFrame, seen: DataFrame, key: str = "story_id") -> DataFrame:
    """Rows whose key was not seen."""
    return df.join(seen.select(key), key, "left_anti")


def overlap(df: DataFrame, seen: DataFrame, key: str = "story_id") -> DataFrame:
    """Rows whose key was seen."""
    return df.join(seen.select(key), key, "left_semi")


def union_distinct(pages: list[DataFrame], key: str, *order: Column | str) -> DataFrame:
    """All pages in one table, one row per key; ``_page`` tells the page of the row kept."""
    numbered = [page.withColumn("_page", F.lit(i)) for i, page in enumerate(pages, 1)]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    return keep_first(together, key, "_page", *order)


def window_candidates(articles: DataFrame, hours: int = 24) -> DataFrame:
    """How many earlier articles lie within ``hours`` of each article, and how far the nearest is.

    Articles enter the window at their time and leave it after ``hours``. Their
    running sum over both counts the candidates without pairing any rows.
    Equal times are ordered by ``story_id``.
    """
    width = hours * 3_600_000_000
    at = micros(F.col("published_at"))
    enter = articles.select("story_id", at.alias("at"), F.lit(1).alias("kind"), F.lit(1).alias("step"))
    # a time exactly `hours` old still counts: leaving comes after entering
    leave = articles.select("story_id", (at + width).alias("at"), F.lit(2).alias("kind"), F.lit(-1).alias("step"))
    counted = running_totals(enter.unionByName(leave), "at", "kind", "story_id", totals={"open": "step"})
    near = last_before(
        counted.where("kind = 1").withColumn("all", F.lit(1)),
        ["all"],
        ["at", "story_id"],
        {"previous_at": "at"},
    )
    gap = F.col("at") - F.col("previous_at")
    return near.select(
        "story_id",
        (F.col("open") - 1).alias("n_candidates"),
        F.when(gap <= width, gap / 1_000_000).alias("nearest_gap_s"),
    )
