"""Pages of a range, newest first, and what the page loop keeps track of."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions.fields import plus_seconds
from newsflow.operators.ordered import number_rows
from newsflow.session import cut

_BLOCK = 100_000  # pages per task in sums over all pages


def assign_pages(
    df: DataFrame,
    per_page: int = 100,
    max_pages: int | None = None,
    time: str = "published_at",
    ties: tuple[str, ...] = ("story_id",),
) -> DataFrame:
    """Number the pages of ``per_page`` rows, newest row first.

    Page edges fall between rows, not between times, so ties are never lost.
    """
    numbered = number_rows(df, F.desc(time), *[F.asc(t) for t in ties], name="_n")
    paged = numbered.withColumn("page", F.ceil(F.col("_n") / per_page)).drop("_n")
    return paged if max_pages is None else paged.where(F.col("page") <= max_pages)


def page_bounds(paged: DataFrame, time: str = "published_at") -> DataFrame:
    return paged.groupBy("page").agg(
        F.count("*").alias("n_rows"), F.max(time).alias("newest"), F.min(time).alias("oldest")
    )


def page_cursor(paged: DataFrame, start, time: str = "published_at") -> DataFrame:
    """Cursor after each page: the next upper bound, and whether the range is done."""
    bounds = page_bounds(paged, time)
    upper = bounds.select((F.col("page") + 1).alias("page"), plus_seconds(F.col("oldest"), -1).alias("upper_bound"))
    return (
        bounds.withColumn("next_end", plus_seconds(F.col("oldest"), -1))
        .withColumn("stop", F.col("next_end") <= start)
        .join(upper, "page", "left")
        .select("page", "n_rows", "upper_bound", "next_end", "stop")
    )


def page_duplicate_counts(paged: DataFrame, key: str = "story_id") -> DataFrame:
    """Rows of each page whose key is new, and rows whose key an earlier page had.

    Keys are counted per page before they meet, so a key with many copies
    brings one row per page.
    """
    per_page = paged.groupBy(key, "page").agg(F.count("*").alias("n"))
    first = per_page.groupBy(key).agg(F.min("page").alias("page"), F.min_by("n", "page").alias("n"))
    rows = paged.select("page", F.lit(1).alias("n_rows"), F.lit(0).alias("new_rows"))
    new = first.select("page", F.lit(0).alias("n_rows"), F.col("n").alias("new_rows"))
    return (
        rows.unionByName(new)
        .groupBy("page")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("new_rows").alias("new_rows"))
        .withColumn("duplicates", F.col("n_rows") - F.col("new_rows"))
    )


def page_running_totals(counts: DataFrame, *columns: str) -> DataFrame:
    """Running sums over the pages of ``counts`` (one row per page, numbered from 1).

    Pages are summed in blocks and the blocks in a second, far smaller step.
    """
    blocked = cut(counts).withColumn("_block", F.floor((F.col("page") - 1) / _BLOCK))
    blocks = blocked.groupBy("_block").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_block", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in columns]
    )
    here = Window.partitionBy("_block").orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocked.withColumns({f"total_{c}": F.sum(c).over(here) for c in columns})
        .join(starts, "_block")
        .withColumns({f"total_{c}": F.col(f"total_{c}") + F.col(f"_start_{c}") for c in columns})
        .drop("_block", *[f"_start_{c}" for c in columns])
    )
