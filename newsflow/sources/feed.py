"""Input tables, and the feed that the document tables stand in for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import html_to_text

FEED_START = "2024-01-01 00:00:00"
MINUTES_APART = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def story_id(doc_id: Column) -> Column:
    return F.concat(F.lit("DOC"), F.lpad(doc_id.cast("string"), 12, "0"))


def published(doc_id: Column) -> Column:
    apart = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (doc_id * MINUTES_APART * 60).cast("decimal(18,6)"))
    return F.lit(FEED_START).cast("timestamp_ntz") + apart


def documents_as_feed(documents: DataFrame) -> DataFrame:
    """Documents under the names a headline feed uses; the first line is the headline."""
    return documents.select(
        story_id(F.col("doc_id")).alias("storyId"),
        F.substring_index("text", "\n", 1).alias("text"),
        F.col("text").alias("body"),
        F.concat(F.lit("NS:"), F.upper("source")).alias("sourceCode"),
        published(F.col("doc_id")).alias("versionCreated"),
        F.col("lang").alias("language"),
        "doc_id",
    )


def page_bodies(pages: DataFrame) -> DataFrame:
    """Story bodies as plain text. Pages are cleaned before they travel."""
    return pages.select(
        story_id(F.col("page_id")).alias("story_id"), html_to_text(F.col("html")).alias("body_text")
    )


def enrich_bodies(articles: DataFrame, bodies: DataFrame) -> DataFrame:
    """Articles with the body of their story; NULL where there is none."""
    return articles.drop("body_text").join(bodies.select("story_id", "body_text"), "story_id", "left")
