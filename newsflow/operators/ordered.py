"""Work that follows one global order, without one task holding a whole group.

Rows are spread over range partitions by the full sort key, so that a key, time
or group that holds a third of the rows is split over many partitions. What a
partition needs from those before it is one row per partition, which is small
enough to broadcast whatever the data size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.session import cut

PART, POS = "_part", "_pos"
_PART_ROWS = 4_000_000
_BITS = 33  # monotonically_increasing_id keeps the position in its lower 33 bits


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``df`` sorted over range partitions, each row with its partition and position.

    The keys should name each row uniquely. The result is written to the shared
    folder, so that all later uses see the same positions. The number of partitions follows
    the number of rows, and is that of the session at least.
    """
    df = cut(df)  # counted, sampled for the ranges, and sorted
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / _PART_ROWS))
    laid = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    return (
        cut(laid)
        .withColumn(PART, F.shiftright("_seq", _BITS))
        .withColumn(POS, F.col("_seq").bitwiseAND(F.lit((1 << _BITS) - 1)))
        .drop("_seq")
    )


def _earlier_parts():
    return Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, *keys: Column | str, name: str = "row_number") -> DataFrame:
    """Number all rows 1, 2, 3, ... in the order of ``keys``."""
    laid = in_order(df, *keys)
    starts = (
        laid.groupBy(PART)
        .agg(F.count("*").alias("_n"))
        .select(PART, F.coalesce(F.sum("_n").over(_earlier_parts()), F.lit(0)).alias("_start"))
    )
    return (
        laid.join(F.broadcast(starts), PART)
        .withColumn(name, F.col("_start") + F.col(POS) + 1)
        .drop(PART, POS, "_start")
    )


def running_totals(df: DataFrame, *keys: Column | str, totals: dict[str, str]) -> DataFrame:
    """Running sums in the order of ``keys``: ``totals`` maps new columns to summed ones."""
    laid = in_order(df, *keys)
    sums = laid.groupBy(PART).agg(*[F.sum(col).alias(f"_sum_{new}") for new, col in totals.items()])
    starts = sums.select(
        PART,
        *[F.coalesce(F.sum(f"_sum_{new}").over(_earlier_parts()), F.lit(0)).alias(f"_start_{new}") for new in totals],
    )
    here = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        laid.withColumns({new: F.sum(col).over(here) for new, col in totals.items()})
        .join(F.broadcast(starts), PART)
        .withColumns({new: F.col(new) + F.col(f"_start_{new}") for new in totals})
        .drop(PART, POS, *[f"_start_{new}" for new in totals])
    )


def last_before(
    df: DataFrame, group: list[str], order: list[str], values: dict[str, str], among: Column | None = None
) -> DataFrame:
    """For each row, values of the last row before it in its group.

    ``values`` maps new columns to columns of that earlier row; ``among`` says
    which rows may be found, all if ``None``. This is a lag over rows of one
    kind and an as-of join when two kinds are united.
    """
    laid = in_order(df, *group, *order)
    findable = F.lit(True) if among is None else among
    carried = F.when(
        findable,
        F.struct(
            *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)],
            *[F.col(col).alias(f"v_{new}") for new, col in values.items()],
        ),
    )
    before = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        laid.groupBy(PART)
        .agg(F.max_by(carried, F.when(findable, F.col(POS))).alias("_tail"))
        .select(PART, F.last("_tail", ignorenulls=True).over(_earlier_parts()).alias("_head"))
    )
    laid = laid.withColumn("_near", F.last(carried, ignorenulls=True).over(before))
    found = F.coalesce("_near", "_head")
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & found[f"g{i}"].eqNullSafe(F.col(g))
    return (
        laid.join(F.broadcast(heads), PART)
        .withColumns({new: F.when(same, found[f"v_{new}"]) for new in values})
        .drop(PART, POS, "_near", "_head")
    )
