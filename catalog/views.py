"""The driver's tables in the roles the operators expect, and rules that fit their invented words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.fields import hours_before, normalize_source
from newsflow.operators.clean import canonical
from newsflow.plans.ingest import tag_articles
from newsflow.rules import Rules
from newsflow.sources.feed import documents_as_feed, story_id, table

AS_OF = "2024-01-31 00:00:00"

RULES = Rules(
    category_words={
        "ALPHA": ["thanedble", "onble"],
        "BETA": ["ontion", "antion"],
        "GAMMA": ["license", "copyright"],
        "DELTA": ["dans la", "nicht", "para"],
    },
    headline_phrases={"EPSILON": ["the and", "de la"]},
    search_terms={
        "ALPHA": ["thanedble", "onble"],
        "BETA": ["ontion", "antion"],
        "GAMMA": ["license"],
        "DELTA": ["dans la", "nicht", "para"],
        "EPSILON": ["the and"],
    },
    urgency_words={1: ["license", "thanedble", "nicht"], 2: ["onble", "dans la", "para"]},
    priority_terms={
        "high_priority": {"score": 10, "terms": ["thanedble", "nicht"]},
        "medium_priority": {"score": 5, "terms": ["onble", "ontion", "dans la"]},
        "low_priority": {"score": 2, "terms": ["antion", "para", "the and", "que"]},
    },
    category_minimum={"ALPHA": 12, "BETA": 7},
    minimum_score=2,
    excluded_sources=["src1"],
)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical articles, one per document."""
    articles = canonical(documents_as_feed(table(spark, folder, "documents")))
    return articles.withColumn("source", normalize_source(F.col("source_code")))


def overlap(articles: DataFrame) -> DataFrame:
    """A feed in which every tenth article arrives again, dated a day later."""
    again = articles.where(F.col("doc_id") % 10 == 0).withColumn("published_at", hours_before(F.col("published_at"), -24))
    return articles.withColumn("arrival", F.lit(1)).unionByName(again.withColumn("arrival", F.lit(2)))


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return tag_articles(feed(spark, folder), RULES)


def links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of articles: one per labelled document."""
    return table(spark, folder, "labels").select(story_id(F.col("doc_id")).alias("story_id"), "quality", "toxic")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")
