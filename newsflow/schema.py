"""Column sets and types of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical article columns; times are UTC wall-clock values.
ARTICLE = T.StructType(
    [
        T.StructField("story_id", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("body_text", T.StringType()),
        T.StructField("source_code", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("language", T.StringType()),
    ]
)

# Names the feeds use for the canonical columns, first match wins.
FEED_NAMES = {
    "story_id": ["story_id", "storyId"],
    "headline": ["headline", "text"],
    "summary": ["summary"],
    "body_text": ["body_text", "body"],
    "source_code": ["source_code", "sourceCode"],
    "published_at": ["published_at", "versionCreated", "publishedAt"],
    "language": ["language"],
}

# Rows of the stored article table.
STORED_ARTICLE = T.StructType(
    [
        T.StructField("story_id", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("body_text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("language", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("urgency_level", T.IntegerType()),
        T.StructField("priority_score", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("published_date", T.DateType()),
    ]
)

ARTICLE_LINK = T.StructType(
    [
        T.StructField("story_id", T.StringType()),
        T.StructField("ric_code", T.StringType()),
        T.StructField("relevance_score", T.DecimalType(3, 2)),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("fetch_start", T.TimestampNTZType()),
        T.StructField("fetch_end", T.TimestampNTZType()),
        T.StructField("articles_fetched", T.LongType()),
        T.StructField("articles_inserted", T.LongType()),
        T.StructField("articles_updated", T.LongType()),
        T.StructField("api_calls", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

# Column defaults of the stored tables.
DEFAULTS = {"language": "en", "urgency_level": 3, "priority_score": 0, "relevance_score": "1.00"}

RUN_STATES = ("running", "completed", "failed")
