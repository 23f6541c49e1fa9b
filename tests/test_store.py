"""Loads, changes and the run log of the store."""

import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsflow.operators import dedup, quality, reports
from newsflow.plans import ingest
from newsflow.rules import Rules
from newsflow.sources import commits, config, feed, runlog, store

ARTICLE = "story_id string, headline string, published_at timestamp_ntz, arrival int"
DAY = datetime(2024, 1, 1, 10)


def as_of():
    return F.lit("2024-02-01").cast("timestamp_ntz")


def files(folder):
    return {str(f.relative_to(folder)) for f in folder.glob("published_date=*/*.parquet")}


def batch(spark, *ids, text="Test Headline"):
    return spark.createDataFrame([(i, f"{text} {i}", DAY, n) for n, i in enumerate(ids)], ARTICLE)


def test_insert_only(spark, tmp_path):
    path = str(tmp_path / "store")
    first = store.insert_only(batch(spark, "1", "2", "3", "4", "5"), path, "arrival", as_of=DAY)
    assert first == {"total_processed": 5, "inserted_count": 5, "failed_count": 0}
    again = store.insert_only(batch(spark, "5", "6", "6", text="Changed"), path, "arrival", as_of=DAY)
    assert again == {"total_processed": 3, "inserted_count": 1, "failed_count": 2}
    stored = {r.story_id: r.headline for r in store.read_articles(spark, path).collect()}
    assert stored["5"] == "Test Headline 5" and stored["6"] == "Changed 6" and len(stored) == 6
    repeat = store.insert_only(batch(spark, "5", "6"), path, "arrival", as_of=DAY)
    assert repeat["inserted_count"] == 0


def test_update(spark):
    df = spark.createDataFrame(
        [("TEST001", "Old Headline", "Old", DAY), ("TEST002", "Other", None, DAY)],
        "story_id string, headline string, summary string, updated_at timestamp_ntz",
    )
    updates = spark.createDataFrame(
        [("TEST001", "Updated Headline", "Updated Summary", "red"), ("NONE", "x", "y", "z")],
        "story_id string, headline string, summary string, colour string",
    )
    got = {r.story_id: tuple(r)[1:] for r in store.update_by_key(df, updates, as_of()).collect()}
    assert got == {
        "TEST001": ("Updated Headline", "Updated Summary", datetime(2024, 2, 1)),
        "TEST002": ("Other", None, DAY),
    }


def test_update_in_place_rewrites_touched_dates_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("1", "a", datetime(2024, 1, 1)), ("2", "b", datetime(2024, 1, 2)), ("3", "c", datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "story_id string, headline string, published_at timestamp_ntz")
    store.append_articles(df.withColumn("updated_at", F.col("published_at")), path)
    before = {p.name for p in (tmp_path / "store" / "published_date=2024-01-01").glob("*.parquet")}
    store.apply_updates(spark, path, spark.createDataFrame([("2", "B")], "story_id string, headline string"), as_of())
    got = {r.story_id: r.headline for r in store.read_articles(spark, path).collect()}
    assert got == {"1": "a", "2": "B", "3": "c"}
    assert before == {p.name for p in (tmp_path / "store" / "published_date=2024-01-01").glob("*.parquet")}


def test_updates_keep_one_row_move_dates_and_set_null(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("1", "a", datetime(2024, 1, 1)), ("2", "b", datetime(2024, 1, 2)), ("3", "c", datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "story_id string, headline string, published_at timestamp_ntz")
    store.append_articles(df.withColumns({"updated_at": F.col("published_at"), "colour": F.lit("red")}), path)
    moved = [("1", None, datetime(2024, 3, 1)), ("2", "x", datetime(2024, 3, 1)), ("2", "x", datetime(2024, 3, 1))]
    updates = spark.createDataFrame(moved, "story_id string, headline string, published_at timestamp_ntz")
    store.apply_updates(spark, path, updates, as_of())
    got = {(r.story_id, r.headline, str(r.published_date)) for r in store.read_articles(spark, path).collect()}
    assert got == {("1", None, "2024-03-01"), ("2", "x", "2024-03-01"), ("3", "c", "2024-01-02")}
    assert store.read_articles(spark, path).count() == 3
    assert "colour" not in spark.read.parquet(path).columns
    assert store.backfill_range(store.read_articles(spark, path), datetime(2024, 1, 1), datetime(2024, 4, 1)).count() == 3


def test_older_files_lack_a_column(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("1", DAY, 7), ("2", DAY, None)], "story_id string, published_at timestamp_ntz, priority_score int")
    store.append_articles(rows.where("story_id = '2'").drop("priority_score"), path)
    store.append_articles(rows.where("story_id = '1'"), path)
    stored = store.read_articles(spark, path)
    assert {r.story_id: r.priority_score for r in stored.collect()} == {"1": 7, "2": 0}
    evolved = store.evolve_add_column(stored.where("false").drop("priority_score"), stored, "priority_score", 0)
    assert {r.story_id: r.priority_score for r in evolved.collect()} == {"1": 7, "2": 0}


def test_delete_cascade(spark):
    links = spark.createDataFrame([("1", "LME"), ("1", "CU"), ("2", "ZN")], "story_id string, ric_code string")
    keys = spark.createDataFrame([("1",), ("9",)], "story_id string")
    articles, left = store.delete_cascade(batch(spark, "1", "2"), links, keys)
    assert [r.story_id for r in articles.collect()] == ["2"]
    assert [r.ric_code for r in left.collect()] == ["ZN"]
    report = {r.table_name: (r.remaining, r.deleted) for r in store.delete_report(batch(spark, "1", "2"), links, keys).collect()}
    assert report == {"news_articles": (1, 1), "news_rics": (1, 2)}


def test_retention_keeps_the_cutoff(spark, tmp_path):
    cutoff = F.lit("2023-01-01").cast("timestamp_ntz")
    times = [datetime(2022, 12, 31, 23, 59, 59), datetime(2023, 1, 1), datetime(2023, 1, 2)]
    df = spark.createDataFrame([(str(i), "h", t) for i, t in enumerate(times)], "story_id string, headline string, published_at timestamp_ntz")
    row = store.retention_report(df, cutoff).first()
    assert (row.kept, row.deleted, row.oldest_kept) == (2, 1, datetime(2023, 1, 1))
    path = str(tmp_path / "a")
    store.append_articles(df, path)
    before = files(tmp_path / "a")
    for _ in range(2):
        store.apply_retention(spark, path, cutoff)
        assert {r.story_id for r in store.read_articles(spark, path).collect()} == {"1", "2"}
    assert files(tmp_path / "a") == {f for f in before if "2022" not in f}
    store.apply_retention(spark, path, F.lit("2023-01-01 10:00:00").cast("timestamp_ntz"))
    assert [str(d) for d in store.stored_dates(spark, path)] == ["2023-01-02"]
    store.append_articles(df.where("story_id = '0'").withColumn("published_at", F.lit(None).cast("timestamp_ntz")), path)
    store.apply_retention(spark, path, F.lit("2023-01-02 10:00:00").cast("timestamp_ntz"))
    assert [r.story_id for r in store.read_articles(spark, path).collect()] == ["0"]


def test_delete_in_place(spark, tmp_path):
    path, links_path = str(tmp_path / "a"), str(tmp_path / "links")
    rows = [("1", datetime(2024, 1, 1)), ("2", datetime(2024, 1, 2)), ("3", datetime(2024, 1, 2)), ("4", None), ("5", datetime(2024, 1, 3))]
    store.append_articles(spark.createDataFrame(rows, "story_id string, published_at timestamp_ntz"), path)
    spark.createDataFrame([("1", "CU"), ("3", "ZN"), ("3", "TIN"), ("9", "AL")], "story_id string, ric_code string").write.parquet(links_path)
    kept = {f for f in files(tmp_path / "a") if "2024-01-03" in f or "2024-01-01" in f}
    keys = spark.createDataFrame([("2",), ("3",), ("3",), ("4",), ("9",)], "story_id string")
    assert store.apply_delete(spark, path, keys, links_path) == {"articles_deleted": 3, "links_deleted": 2}
    assert {r.story_id for r in store.read_articles(spark, path).collect()} == {"1", "5"}
    assert files(tmp_path / "a") == kept
    assert {r.story_id for r in spark.read.parquet(links_path).collect()} == {"1", "9"}
    assert store.apply_delete(spark, path, keys, links_path) == {"articles_deleted": 0, "links_deleted": 0}
    assert store.apply_delete(spark, str(tmp_path / "none"), keys)["articles_deleted"] == 0


def test_latest_gives_what_is_asked_for(spark):
    df = batch(spark, *[f"{i:03d}" for i in range(600)])
    assert store.scan_latest(df, 1000).count() == 600
    assert store.scan_latest(df, 0).count() == 0
    with pytest.raises(ValueError):
        store.scan_latest(df, 1000, max_count=500)
    assert store.scan_latest(df).count() == 100
    assert store.scan_latest(df, 5, predicate=F.col("story_id") > "597").count() == 2


def test_since_high_water(spark):
    source = spark.createDataFrame(
        [("a", datetime(2024, 1, 31, 10)), ("b", datetime(2024, 1, 31, 10, 0, 1)), ("c", datetime(2024, 1, 30))],
        "story_id string, published_at timestamp_ntz",
    )
    stored = source.where("story_id = 'a'")
    assert [r.story_id for r in store.since_high_water(source, stored, as_of()).collect()] == ["b"]
    empty = source.where("false")
    assert {r.story_id for r in store.since_high_water(source, empty, as_of()).collect()} == {"a", "b"}


def test_exact_duplicates(spark):
    rows = [("001", "News A", 1), ("002", "News B", 2), ("001", "News A again", 3)]
    df = spark.createDataFrame(rows, "story_id string, headline string, arrival int")
    assert {(r.story_id, r.headline) for r in dedup.keep_first(df, "story_id", "arrival").collect()} == {
        ("001", "News A"), ("002", "News B"),
    }
    united = dedup.union_distinct([df.where("arrival > 1"), df.drop("headline")], "story_id", "arrival")
    assert {(r.story_id, r._page) for r in united.collect()} == {("001", 1), ("002", 1)}
    assert dedup.overlap(df, df.where("arrival = 2")).count() == 1


def test_run_log(spark):
    started = spark.createDataFrame([("r1", DAY), ("r2", DAY), ("r3", DAY)], "run_id string, fetch_start timestamp_ntz")
    log = runlog.start_runs(started)
    assert {r.status for r in log.collect()} == {"running"}
    finished = spark.createDataFrame(
        [("r1", DAY, 100, 95, 5, 1, None), ("r2", DAY, 0, 0, 0, 1, "timeout")],
        "run_id string, fetch_end timestamp_ntz, articles_fetched long, articles_inserted long, articles_updated long, api_calls long, error_message string",
    )
    done = {r.run_id: r for r in runlog.complete_runs(log, finished).collect()}
    assert (done["r1"].status, done["r1"].articles_fetched, done["r1"].articles_inserted, done["r1"].articles_updated) == ("completed", 100, 95, 5)
    assert done["r2"].status == "failed" and done["r3"].status == "running" and done["r3"].fetch_end is None


def test_constraints(spark):
    links = spark.createDataFrame(
        [("1", "CU", "1.00"), ("1", "CU", "9.99"), ("2", "ZN", "10.00"), ("9", "ZN", None)], "story_id string, ric_code string, relevance string"
    )
    checks = quality.constraint_report(
        quality.repeated_keys(links, ["story_id", "ric_code"], "repeated"),
        quality.orphans(links, batch(spark, "1", "2"), "story_id", "orphan"),
        quality.count_broken(links, {"decimal": quality.outside_decimal("relevance", 3, 2), "missing": F.col("relevance").isNull()}),
    )
    assert {r.check_name: r.violations for r in checks.collect()} == {"repeated": 1, "orphan": 1, "decimal": 1, "missing": 1}


def test_rules_file(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{"news_filtering": {"priority_scoring": {"keywords":\n {"high_priority": {"score": 10, "terms": ["strike", "supply cut"]}}}}}')
    rows = config.read_rules(spark, str(path)).collect()
    assert {(r.level, r.score, r.term) for r in rows} == {("high_priority", 10, "strike"), ("high_priority", 10, "supply cut")}
    assert config.as_priority_terms(rows)["high_priority"]["score"] == 10


def test_reports_on_nothing(spark):
    empty = spark.createDataFrame([], "story_id string, body_text string, ts timestamp_ntz, succeeded boolean, seconds double")
    assert tuple(reports.body_coverage(empty).first()) == (0, 0, 0.0)
    stats = reports.api_call_stats(empty).first()
    assert (stats.total_calls, stats.success_rate, stats.calls_per_minute) == (0, 0.0, 0.0)


def test_fan_out_counts(spark):
    matched = spark.createDataFrame([("1", ["A", "B"]), ("2", ["B"]), ("3", ["A", "B"]), ("4", [])], "story_id string, categories array<string>")
    got = store.ingest_by_category(matched, batch(spark, "3"))
    assert {r.category: tuple(r)[1:] for r in got.collect()} == {"A": (2, 1, 1, 0), "B": (3, 1, 2, 1)}
    total = {r.category: (r.fetched, r.stored, r.failed, r.success) for r in reports.ingest_summary(got).collect()}
    assert total["ALL"] == (5, 2, 3, True)


def test_run_ingest(spark, tmp_path):
    rows = [
        ("1", "BREAKING: Copper strike hits LME supply", "2024-01-01T10:00:00Z", "NS:RTRS"),
        ("1", "Second arrival", "2024-01-01T10:05:00Z", "NS:RTRS"),
        ("2", "Breaking: copper strike hits LME supply", "2024-01-01T11:00:00Z", "NS:ABC"),
        ("3", "Zinc price outlook", "2024-01-01T12:00:00Z", "NS:SPAMWIRE"),
        ("4", "Zinc price outlook", "2024-01-01T12:00:00Z", "NS:ABC"),
        ("5", " ", "2024-01-01T12:00:00Z", "NS:ABC"),
        ("6", "No score here", "bad", "NS:ABC"),
        ("7", "Nothing of note", "2024-01-01T13:00:00Z", "NS:ABC"),
    ]
    arrived = spark.createDataFrame(rows, "storyId string, text string, versionCreated string, sourceCode string")
    bodies = spark.createDataFrame([("4", "tin")], "story_id string, body_text string")
    path = str(tmp_path / "store")
    rules = Rules(minimum_score=5)
    counts = ingest.run_ingest(arrived, rules, path, as_of(), bodies=bodies)
    assert counts == {"articles_fetched": 8, "articles_inserted": 2, "articles_failed": 6}
    stored = {r.story_id: r for r in store.read_articles(spark, path).collect()}
    assert set(stored) == {"1", "4"}
    assert stored["1"].source == "Reuters" and stored["1"].urgency_level == 1 and stored["1"].priority_score == 20
    assert stored["4"].categories == ["ZINC", "TIN"] and stored["4"].language == "en"
    assert stored["1"].headline == "BREAKING: Copper strike hits LME supply" and stored["4"].body_text == "tin"
    reports.register_views(store.read_articles(spark, path))
    assert spark.sql("SELECT sum(total_articles) FROM news_quality_check").first()[0] == 2
    assert spark.sql("SELECT category FROM news_statistics WHERE source = 'NS:ABC'").first()[0] == "ZINC,TIN"
    again = ingest.run_ingest(arrived, rules, path, as_of(), bodies=bodies)
    assert again["articles_inserted"] == 0


def test_tags_and_texts_come_from_the_same_arrival(spark):
    """Arrivals of one story that differ in their texts only."""
    words = ["copper strike", "zinc price", "tin demand", "nickel supply", "forex report"]
    rows = [(f"{i}", "Headline", "2024-01-01T10:00:00Z", "NS:ABC", f"{i} {w}") for i in range(8) for w in words] * 2
    arrived = spark.createDataFrame(rows, "storyId string, text string, versionCreated string, sourceCode string, body string")
    empty = store.read_articles(spark, "/nowhere/news")
    got = ingest.new_articles(arrived, Rules(similarity=None), lambda df: df, empty).collect()
    assert len(got) == 8
    for r in got:
        assert r.body_text.split()[0] == r.story_id and r.categories == [r.body_text.split()[1].upper()]


@pytest.mark.parametrize("page_id, expected", [(5, "DOC000000000005"), (123456789, "DOC000123456789")])
def test_story_id(spark, page_id, expected):
    assert spark.range(1).select(feed.story_id(F.lit(page_id))).first()[0] == expected


def test_whole_rules_from_a_file(spark, tmp_path):
    held = {
        "text_processing": {"max_headline_length": 90},
        "news_filtering": {
            "priority_scoring": {"enabled": True, "minimum_score": 4, "category_minimum_scores": {"ZINC": 9}, "keywords": {"only": {"score": 3, "terms": ["x"]}}},
            "source_filtering": {"enabled": False, "excluded_sources": ["spam"]},
            "duplicate_detection": {"enabled": True, "similarity_threshold": 0.7, "check_window_hours": 6},
        },
    }
    (tmp_path / "c.json").write_text(json.dumps(held, indent=1))
    rules = config.read_whole_rules(spark, str(tmp_path / "c.json"))
    assert (rules.minimum_score, rules.category_minimum, rules.excluded_sources) == (4, {"ZINC": 9}, [])
    assert (rules.similarity, rules.window_hours, rules.max_headline_length) == (0.7, 6, 90)
    assert rules.priority_terms == {"only": {"score": 3, "terms": ["x"]}} and rules.category_words == Rules().category_words
    held["news_filtering"]["duplicate_detection"]["enabled"] = False
    (tmp_path / "d.json").write_text(json.dumps(held))
    assert config.read_whole_rules(spark, str(tmp_path / "d.json")).similarity is None


def test_few_keys_read_their_buckets_and_many_do_not_shuffle_the_index(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(3000).select(F.col("id").cast("string").alias("story_id"), F.lit(DAY).cast("timestamp_ntz").alias("published_at"))
    store.append_articles(rows, path)
    few = commits.stored_among(rows.limit(5).select(F.col("story_id").alias("key")), path)
    text = few._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SelectedBucketsCount: [1-5] out of 64", text) and few.count() == 5
    many = rows.union(rows.limit(9).withColumn("story_id", F.lit("new"))).select(F.col("story_id").alias("key")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = commits.stored_among(many, path)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    branch = text[text.index("SortMergeJoin") :]
    scans = re.findall(r"(Exchange hashpartitioning[^\n]*)|(FileScan parquet[^\n]*Bucketed: true)", branch)
    assert any(b for _, b in scans) and len([a for a, _ in scans if a]) <= 2  # of the batch: distinct, then its buckets


def test_dropped_deleted_and_moved_stories_in_the_index(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(str(i), datetime(2024, 1, 1 + i)) for i in range(6)]
    df = spark.createDataFrame(rows, "story_id string, published_at timestamp_ntz")
    store.append_articles(df, path)
    store.apply_retention(spark, path, F.lit("2024-01-03").cast("timestamp_ntz"))
    store.apply_delete(spark, path, spark.createDataFrame([("5",)], "story_id string"))
    known = lambda: {"0", "1", "2", "3", "4", "5"} - {r.story_id for r in store.not_stored(df, path).collect()}
    assert known() == {"2", "3", "4"}
    commits.compact_index(spark, path)
    assert known() == {"2", "3", "4"} and len(commits.data_files(spark, path + "/_ids")) <= 64
    assert store.insert_only(df, path)["inserted_count"] == 3  # stories that went may come again
    assert known() == {"0", "1", "2", "3", "4", "5"}
    store.apply_updates(spark, path, spark.createDataFrame([("3", datetime(2023, 12, 1))], "story_id string, published_at timestamp_ntz"), as_of())
    store.apply_retention(spark, path, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert known() == {"0", "1", "2", "4", "5"}


def test_a_change_over_two_dates_that_breaks_off_is_finished(spark, tmp_path, monkeypatch):
    path, whole = str(tmp_path / "a"), str(tmp_path / "b")
    rows = [(str(i), f"h{i}", datetime(2024, 1, 1 + i % 3), DAY) for i in range(9)]
    df = spark.createDataFrame(rows, "story_id string, headline string, published_at timestamp_ntz, updated_at timestamp_ntz")
    updates = spark.createDataFrame([("0", "new"), ("1", "new")], "story_id string, headline string")
    for p in (path, whole):
        store.append_articles(df, p)
    store.apply_updates(spark, whole, updates, as_of())
    untouched = {f for f in files(tmp_path / "a") if "2024-01-03" in f}
    plain, calls = commits.remove, []

    def remove(spark, name):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("stopped")
        plain(spark, name)

    with monkeypatch.context() as stop:
        stop.setattr(commits, "remove", remove)
        with pytest.raises(OSError):
            store.apply_updates(spark, path, updates, as_of())
    read = lambda p: sorted(map(str, store.read_articles(spark, p).collect()))
    assert read(path) == read(whole)  # reading finishes the change
    assert untouched <= files(tmp_path / "a")


def test_links_by_parts(spark, tmp_path):
    path, links = str(tmp_path / "a"), str(tmp_path / "links")
    df = spark.createDataFrame([(str(i), DAY) for i in range(50)], "story_id string, published_at timestamp_ntz")
    store.append_articles(df, path)
    store.write_links(df.select("story_id", F.lit("CU").alias("ric_code")), links)
    before = {str(f.relative_to(links)) for f in (tmp_path / "links").glob("part=*/*.parquet")}
    gone = spark.createDataFrame([("7",), ("none",)], "story_id string")
    assert store.apply_delete(spark, path, gone, links) == {"articles_deleted": 1, "links_deleted": 1}
    after = {str(f.relative_to(links)) for f in (tmp_path / "links").glob("part=*/*.parquet")}
    assert len({f.split("/")[0] for f in before - after}) == 1 and store.read_links(spark, links).count() == 49
    assert {r.story_id for r in store.with_link(df, store.read_links(spark, links)).collect()} == {str(i) for i in range(50) if i != 7}


def test_loads_write_a_log_and_jobs_go_on(spark, tmp_path):
    path, rules = str(tmp_path / "store"), Rules(similarity=None)
    rows = [(str(i), f"copper price {i}", DAY + timedelta(minutes=i), "NS:ABC") for i in range(25)]
    feed_ = spark.createDataFrame(rows, "storyId string, text string, published_at timestamp_ntz, sourceCode string")
    empty = ingest.run_ingest(feed_.where("false"), rules, path, as_of(), load="empty")
    assert empty["articles_fetched"] == 0
    with pytest.raises(Exception, match="broken"):
        broken = feed_.withColumn("text", F.when(F.col("storyId") == "3", F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
        ingest.run_ingest(broken, rules, path, as_of(), load="fails")
    runlog.open_run(spark, path, "stuck", as_of())
    start, end = (F.lit(str(DAY + timedelta(minutes=m))).cast("timestamp_ntz") for m in (0, 19))
    assert ingest.backfill(feed_, rules, path, as_of(), start, end, 7) == 3
    assert ingest.backfill(feed_, rules, path, as_of(), start, end, 7) == 0
    assert ingest.load_since_newest(feed_, rules, path, as_of())["articles_inserted"] == 5
    log = {r.run_id: (r.status, r.articles_inserted) for r in runlog.read_log(spark, path).collect()}
    assert log["empty"] == ("failed", 0) and log["fails"] == ("failed", 0) and log["stuck"] == ("failed", 0)
    assert [log[f"backfill-{n:08d}"] for n in range(3)] == [("completed", 7), ("completed", 7), ("completed", 6)]
    assert store.read_articles(spark, path).count() == 25


def test_steps_over_files_do_not_grow_with_the_dates(spark, tmp_path, monkeypatch):
    """Lists come over in one piece, new dates are moved as folders: few calls of the file system for each date."""

    def calls(days, name):
        path, made = str(tmp_path / name), []
        plain = commits._path
        monkeypatch.setattr(commits, "_path", lambda *a: made.append(a) or plain(*a))
        df = spark.range(days * 2).select(
            F.col("id").cast("string").alias("story_id"),
            F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(int(id / 2))").alias("published_at"),
        )
        assert store.append_articles(df, path) == days * 2
        written = len(made)
        assert store.read_articles(spark, path).count() == days * 2 and len(store.stored_dates(spark, path)) == days
        read = len(made) - written
        assert store.apply_delete(spark, path, df.where("story_id = '0' OR story_id = '5'")) == {"articles_deleted": 2, "links_deleted": 0}
        assert store.read_articles(spark, path).count() == days * 2 - 2
        monkeypatch.setattr(commits, "_path", plain)
        return written, read

    (written, read), (more_written, more_read) = calls(5, "few"), calls(45, "many")
    assert more_read == read and more_written - written <= 2 * 40 + 2 * commits.BUCKETS


def test_dates_that_a_store_has_get_files_beside(spark, tmp_path):
    """A change whose dates are partly there, stopped after some moves, is finished by the next read."""
    path = str(tmp_path / "store")
    store.append_articles(batch(spark, "1"), path)
    rows = spark.createDataFrame([("2", DAY), ("3", DAY + timedelta(days=1)), ("4", None)], "story_id string, published_at timestamp_ntz")
    store.append_articles(rows, path)
    assert len(files(tmp_path / "store")) == 4
    store.apply_delete(spark, path, spark.createDataFrame([("4",)], "story_id string"))
    assert {r.story_id for r in store.read_articles(spark, path).collect()} == {"1", "2", "3"}


def test_stored_stories_are_not_tagged_again(spark, tmp_path, monkeypatch):
    path, rules, tagged = str(tmp_path / "store"), Rules(similarity=None), []
    rows = [(str(i), f"copper price {i}", DAY + timedelta(minutes=i), "NS:ABC") for i in range(6)]
    feed_ = spark.createDataFrame(rows, "storyId string, text string, published_at timestamp_ntz, sourceCode string")
    assert ingest.run_ingest(feed_.where("storyId < '4'"), rules, path, as_of())["articles_inserted"] == 4
    plain = ingest.tag_articles
    monkeypatch.setattr(ingest, "tag_articles", lambda df, *a: tagged.append(sorted(r.story_id for r in df.collect())) or plain(df, *a))
    counts = ingest.run_ingest(feed_, rules, path, as_of())
    assert counts == {"articles_fetched": 6, "articles_inserted": 2, "articles_failed": 4} and tagged == [["4", "5"]]


def test_headlines_do_not_split_whole_texts(spark):
    df = spark.createDataFrame([(i, t, "s", "en") for i, t in enumerate(["one\ntwo\nthree", "one", "", "\ntwo", None])], "doc_id long, text string, source string, lang string")
    rows = feed.documents_as_feed(df)
    assert [r.text for r in rows.orderBy("doc_id").collect()] == ["one", "one", "", "", None]
    assert "split" not in rows._jdf.queryExecution().executedPlan().toString().lower()
