"""Shape of the plans that matter at scale."""

import re

from pyspark.sql import functions as F

from catalog import views
from catalog.queries import QUERIES
from newsflow.operators import dedup, reports
from newsflow.plans.ingest import tag_articles
from newsflow.sources import store
from newsflow.sources.feed import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text))


def test_keep_first_limits_keys_before_the_shuffle(spark):
    text = plan(dedup.keep_first(views.overlap(views.feed(spark, FOLDER)), "story_id", "arrival"))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.rindex("Partial")
    assert exchanges(text) == 1


def test_top_n_limits_groups_before_the_shuffle(spark):
    text = plan(reports.top_n_per_group(views.events(spark, FOLDER), "event_type", 10, "ts", "event_id"))
    assert "Partial" in text and exchanges(text) == 1


def test_latest_is_a_top_k(spark):
    text = plan(store.scan_latest(views.feed(spark, FOLDER), 100))
    assert "TakeOrderedAndProject" in text and exchanges(text) == 0


def test_tagging_does_not_shuffle(spark):
    text = plan(tag_articles(views.feed(spark, FOLDER), views.RULES).where("priority_score > 3"))
    assert exchanges(text) == 0
    assert text.count("RLIKE") == text[text.index("Generate"):].split("\n")[0].count("RLIKE")


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(QUERIES["retention_cleanup"](spark, FOLDER))
    assert "ReadSchema: struct<published_at:timestamp_ntz>" in text
    text = plan(store.lookup(table(spark, FOLDER, "pages").withColumnRenamed("url", "story_id").select("story_id"), ["a"]))
    assert "PushedFilters: [IsNotNull(url), EqualTo(url,a)]" in text
    text = plan(QUERIES["incremental_since_hwm"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in text


def test_dates_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append_articles(views.feed(spark, FOLDER).select("story_id", "published_at"), path)
    kept = store.read_articles(spark, path).where(F.col("published_date") >= F.lit("2024-01-02").cast("date"))
    assert re.search(r"PartitionFilters: \[.*published_date.*>= 2024-01-02", plan(kept))


def test_writes_rebalance_by_date(spark):
    dated = views.feed(spark, FOLDER).select("story_id", F.to_date("published_at").alias("published_date"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(store.by_date(dated))
