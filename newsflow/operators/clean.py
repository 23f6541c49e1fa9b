"""From feed rows to valid canonical articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.fields import is_excluded_source, normalize_source, to_utc
from newsflow.functions.text import is_blank, truncate
from newsflow.schema import ARTICLE, DEFAULTS, FEED_NAMES


def canonical(feed: DataFrame) -> DataFrame:
    """Feed columns under their canonical names and types; absent columns are NULL."""
    columns = []
    for field in ARTICLE.fields:
        name = next((n for n in FEED_NAMES[field.name] if n in feed.columns), None)
        if name is None:
            col = F.lit(None).cast(field.dataType)
        elif field.name == "published_at":
            col = to_utc(F.col(name))
        else:
            col = F.col(name).cast(field.dataType)
        columns.append(col.alias(field.name))
    taken = {n for names in FEED_NAMES.values() for n in names}
    extra = [F.col(c) for c in feed.columns if c not in taken]
    return feed.select(*columns, *extra)


def reject_reason() -> Column:
    """Why a canonical row cannot be stored; NULL for valid rows."""
    return (
        F.when(is_blank(F.col("story_id")), "story_id")
        .when(is_blank(F.col("headline")), "headline")
        .when(F.col("published_at").isNull(), "published_at")
    )


def valid(articles: DataFrame) -> DataFrame:
    return articles.where(reject_reason().isNull())


def rejected(articles: DataFrame) -> DataFrame:
    """Invalid rows, kept with the reason."""
    return articles.withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())


def normalize_articles(feed: DataFrame) -> DataFrame:
    """Valid canonical articles with a readable source name."""
    return valid(canonical(feed)).withColumn("source", normalize_source(F.col("source_code")))


def standardize_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Times as UTC; rows whose time does not parse are dropped."""
    return df.withColumn(column, to_utc(F.col(column))).where(F.col(column).isNotNull())


def truncate_headline(df: DataFrame, length: int = 500) -> DataFrame:
    return df.withColumn("headline", truncate(F.col("headline"), length))


def filter_date_range(df: DataFrame, start, end, column: str = "published_at") -> DataFrame:
    """Rows between two times, both included; ``None`` leaves a side open."""
    if start is not None:
        df = df.where(F.col(column) >= start)
    if end is not None:
        df = df.where(F.col(column) <= end)
    return df


def filter_sources(df: DataFrame, excluded: list[str], column: str = "source_code") -> DataFrame:
    return df.where(~is_excluded_source(F.col(column), excluded))


def fill_defaults(df: DataFrame, defaults: dict = DEFAULTS) -> DataFrame:
    """Column defaults of the stored tables, for the columns ``df`` has."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        for name, value in defaults.items()
        if name in df.columns
    }
    return df.withColumns(filled)
