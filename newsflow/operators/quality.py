"""Constraint checks of the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _report(df: DataFrame, check: str, count: Column) -> DataFrame:
    return df.agg(count.cast("bigint").alias("violations")).select(F.lit(check).alias("check_name"), "violations")


def count_broken(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break each row-wise check, all counted in one pass."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return counts.unpivot([], list(checks), "check_name", "violations")


def repeated_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return _report(repeated, check, F.count("*"))


def orphans(child: DataFrame, parent: DataFrame, key: str, check: str) -> DataFrame:
    """Child rows without a parent."""
    return _report(child.join(parent.select(key), key, "left_anti"), check, F.count("*"))


def outside_domain(column: str, allowed: tuple) -> Column:
    return F.col(column).isNull() | ~F.col(column).isin(*allowed)


def outside_decimal(column: str, precision: int, scale: int) -> Column:
    """A value that DECIMAL(precision, scale) cannot hold."""
    return F.col(column).isNotNull() & F.col(column).try_cast(f"decimal({precision},{scale})").isNull()


def constraint_report(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
