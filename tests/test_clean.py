"""Feed rows to valid articles."""

from datetime import datetime

from pyspark.sql import functions as F

from newsflow.functions import fields
from newsflow.operators import clean

TEST_FEED = "storyId string, headline string, summary string, sourceCode string, publishedAt string, language string"


def test_both_feed_shapes(spark):
    rows = [("001", "Market Update", "Summary 1", "Reuters", "2024-01-01T10:00:00Z", "en")]
    one = clean.normalize_articles(spark.createDataFrame(rows, TEST_FEED)).first()
    assert (one.story_id, one.headline, one.summary, one.source) == ("001", "Market Update", "Summary 1", "Reuters")
    assert one.published_at == datetime(2024, 1, 1, 10)
    live = spark.createDataFrame(
        [("1", "Text", "2024-01-01T10:00:00+02:00", "NS:RTRS")], "storyId string, text string, versionCreated string, sourceCode string"
    )
    two = clean.normalize_articles(live).first()
    assert (two.headline, two.source, two.summary, two.language) == ("Text", "Reuters", None, None)
    assert two.published_at == datetime(2024, 1, 1, 8)


def test_absent_columns_are_null(spark):
    df = spark.createDataFrame([("001", "Market Update", "EQUITY", "en")], "storyId string, headline string, category string, language string")
    row = clean.canonical(df).first()
    assert row.published_at is None and row.source_code is None and row.category == "EQUITY"


def test_invalid_rows(spark):
    rows = [
        ("001", "Valid", "2024-01-01T10:00:00Z"),
        (None, "", "invalid-date"),
        ("003", "Another Valid", "2024-01-01T12:00:00Z"),
        ("  ", "x", "2024-01-01T12:00:00Z"),
        ("005", "　", "2024-01-01T12:00:00Z"),
        ("006", "x", "invalid-date"),
    ]
    canonical = clean.canonical(spark.createDataFrame(rows, "storyId string, headline string, publishedAt string"))
    assert {r.story_id for r in clean.valid(canonical).collect()} == {"001", "003"}
    reasons = {(r.story_id, r.reason) for r in clean.rejected(canonical).collect()}
    assert reasons == {(None, "story_id"), ("  ", "story_id"), ("005", "headline"), ("006", "published_at")}


def test_date_range_includes_both_ends(spark):
    rows = [("001", "2024-01-01 10:00"), ("002", "2024-01-15 10:00"), ("003", "2024-02-01 10:00"), ("a", "2024-01-10"), ("z", "2024-01-20")]
    df = spark.createDataFrame(rows, "story_id string, t string").select("story_id", fields.to_utc(F.col("t")).alias("published_at"))
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10", "2024-01-20"))
    got = {r.story_id for r in clean.filter_date_range(df, start, end).collect()}
    assert got == {"002", "a", "z"}


def test_sources(spark):
    df = spark.createDataFrame([("NS:RTRS",), ("NS:ABC",), ("NS:SPAMWIRE",), ("RTRS",), (None,), ("spam:ABC",)], "source_code string")
    kept = clean.filter_sources(df, ["spam", "advertisement"])
    got = [r[0] for r in kept.select(fields.normalize_source(F.col("source_code"))).collect()]
    assert got == ["Reuters", "NS:ABC", "Reuters", None, "spam:ABC"]


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, 7)], "language string, urgency_level int, priority_score int")
    assert tuple(clean.fill_defaults(df).first()) == ("en", 3, 7)


def test_mask_and_previous_day(spark):
    df = spark.sql("SELECT map('API_KEY', 'x', 'count', '5', 'my_token', 'y') AS p, TIMESTAMP_NTZ'2024-03-01 10:00:00' AS t")
    start, end = fields.previous_day(F.col("t"))
    row = df.select(fields.mask_params(F.col("p"), ["api_key", "token"]).alias("p"), start.alias("s"), end.alias("e")).first()
    assert row.p == {"API_KEY": "*" * 8, "count": "5", "my_token": "*" * 8}
    assert (row.s, row.e) == (datetime(2024, 2, 29), datetime(2024, 2, 29, 23, 59, 59))
    assert tuple(df.select(*fields.day_before(F.col("t"))).first()) == (datetime(2024, 2, 29), datetime(2024, 3, 1))
