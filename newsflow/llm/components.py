"""Connected components by large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import keep


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, component)``: the smallest node each one reaches.

    Nodes without an edge to another node are left out, as are edges with a null end.
    Both steps group by node with partial minima, so a hub with a third of all
    edges sends one row per task; its joins back are left to adaptive execution.
    """
    both = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = keep(both.distinct(), "edges")
    mark = _mark(now)
    while True:
        now = keep(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.where("u <> v")
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
