"""One query per operator, each over whole tables of a folder."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views
from catalog.views import RULES
from newsflow.functions import fields, tagging, text
from newsflow.operators import clean, dedup, language, neardup, paging, quality, reports
from newsflow.plans import ingest, maintenance
from newsflow.plans.stream_ingest import ingest_stream, load_stream
from newsflow.schema import DOCUMENT, EVENT
from newsflow.session import prepare, scratch_path
from newsflow.sources import config, feed as feeds, runlog, store
from newsflow.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE = ("2024-01-01 06:04:00", "2024-01-03 17:27:00")


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        return run(prepare(spark), folder)

    QUERIES[run.__name__] = prepared
    return run


def _time(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _ids(df: DataFrame, condition: str) -> DataFrame:
    return df.where(condition).select("story_id")


# -- sources and sinks ---------------------------------------------------------------------


@query
def scan_latest(spark, folder):
    return store.scan_latest(views.feed(spark, folder), 100).select("story_id", "headline", "published_at")


@query
def backfill_range(spark, folder):
    start, end = map(_time, RANGE)
    return store.backfill_range(views.overlap(views.feed(spark, folder)), start, end, "arrival").select(
        "story_id", "published_at"
    )


@query
def load_range_forward(spark, folder):
    start, end = map(_time, RANGE)
    return store.load_range_forward(views.overlap(views.feed(spark, folder)), start, end, "arrival").select(
        "story_id", "published_at"
    )


@query
def keyset_pages(spark, folder):
    events = views.events(spark, folder).select("event_id", "ts")
    return paging.page_bounds(paging.assign_pages(events, 100, time="ts", ties=("event_id",)), "ts")


@query
def incremental_since_hwm(spark, folder):
    events = views.events(spark, folder)
    stored = events.where(F.col("ts") < _time("2024-01-20 00:00:00"))
    return store.since_high_water(events, stored, views.as_of(), "ts").select("event_id", "ts")


def _store_of(articles, name):
    """A new store below the shared folder."""
    path = scratch_path(articles.sparkSession, name)
    store.append_articles(articles, path)
    return path


def _event_store(spark, folder):
    """The events as stored articles, their types as sources."""
    events = views.events(spark, folder)
    kept = events.select(F.col("event_id").cast("string").alias("story_id"), F.col("event_type").alias("source"), F.col("ts").alias("published_at"))
    return _store_of(kept, "events")


@query
def ingest_insert_only(spark, folder):
    """A load into a store that holds every third article; the second one finds nothing new."""
    articles = views.feed(spark, folder)
    path = _store_of(articles.where("doc_id % 3 = 0"), "insert_only")
    before = store.read_articles(spark, path).count()
    counts = store.insert_only(views.overlap(articles), path, "arrival")
    again = store.insert_only(views.overlap(articles), path, "arrival")["inserted_count"]
    inserted, total = store.read_articles(spark, path).count() - before + again, counts["total_processed"]
    row = (total, inserted, total - inserted)
    return spark.createDataFrame([row], "total_processed long, inserted_count long, failed_count long")


def _by_category(spark, folder):
    articles = views.feed(spark, folder)
    searched = articles.withColumn("t", tagging.full_text(F.col("headline"), F.col("body_text")))
    matched = text.compute_once(
        searched, {"categories": tagging.searched_categories(F.col("t"), RULES.search_terms)}
    ).drop("t")
    return store.ingest_by_category(matched, articles.where("doc_id % 5 = 0"))


@query
def ingest_by_category(spark, folder):
    return _by_category(spark, folder)


def _run_log(spark, folder):
    events = views.events(spark, folder)
    failed = F.col("event_type") == "error"
    calls = events.select(
        F.date_format("ts", "yyyy-MM-dd HH").alias("run_id"),
        "ts",
        F.col("event_id").alias("call_id"),
        (~failed).alias("succeeded"),
        F.when(failed, F.col("props")).alias("error"),
    )
    last_hour = events.agg(F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz")).scalar()
    return runlog.runs_from_calls(calls, last_hour)


@query
def fetch_log(spark, folder):
    return _run_log(spark, folder)


@query
def evolve_add_column(spark, folder):
    articles = views.tagged(spark, folder)
    path = _store_of(articles.where("doc_id % 2 = 0").select("story_id", "published_at"), "evolved")
    newer = articles.where("doc_id % 2 = 1").select(
        "story_id", "published_at", F.when(F.col("doc_id") % 4 != 1, F.col("priority_score")).alias("priority_score")
    )
    store.append_articles(newer, path)
    return store.read_articles(spark, path).select("story_id", "priority_score")


@query
def rules_from_json(spark, folder):
    """Rules read from a configuration text, and how many articles each term finds."""
    text_ = json.dumps({"keywords": RULES.priority_terms})
    rules = config.rule_rows(spark.range(1).select(F.lit(text_).alias("config")), "config")
    terms = [t for level in config.as_priority_terms(rules.collect()).values() for t in level["terms"]]
    searched = tagging.full_text(F.col("headline"), F.col("body_text"))
    found = (
        views.feed(spark, folder)
        .select(searched.alias("t"))
        .agg(*[F.count_if(F.col("t").contains(term)).alias(term) for term in terms])
        .unpivot([], terms, "term", "n_articles")
    )
    return rules.join(found, "term").select("level", "score", "term", "n_articles")


# -- projections, filters, predicates ------------------------------------------------------


@query
def normalize_articles(spark, folder):
    feed = feeds.documents_as_feed(feeds.table(spark, folder, "documents"))
    return clean.normalize_articles(feed).select(
        "story_id", "headline", "body_text", "source", "published_at", "language"
    )


def _with_gaps(articles: DataFrame) -> DataFrame:
    """Some ids, headlines and times blanked."""
    return articles.withColumns(
        {
            "story_id": F.when(F.col("doc_id") % 17 == 0, F.lit("  ")).otherwise(F.col("story_id")),
            "headline": F.when(F.col("doc_id") % 19 == 0, F.lit("　")).otherwise(F.col("headline")),
            "published_at": F.when(F.col("doc_id") % 23 != 0, F.col("published_at")),
        }
    )


@query
def validate_required(spark, folder):
    checked = _with_gaps(views.feed(spark, folder)).withColumn("reason", F.coalesce(clean.reject_reason(), F.lit("valid")))
    return checked.groupBy("reason").agg(F.count("*").alias("n"))


@query
def truncate_headline(spark, folder):
    return clean.truncate_headline(views.feed(spark, folder)).select("story_id", "headline")


@query
def standardize_timestamp(spark, folder):
    written = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    as_text = views.feed(spark, folder).select(
        "story_id", F.when(F.col("doc_id") % 13 == 0, F.lit("invalid-date")).otherwise(written).alias("published_at")
    )
    return clean.standardize_timestamp(as_text, "published_at")


@query
def filter_date_range(spark, folder):
    events = views.events(spark, folder).select("event_id", "ts")
    start, end = (events.where(F.col("event_id") == i).select("ts").scalar() for i in (100, 700))
    return clean.filter_date_range(events, start, end, "ts")


@query
def lookup_by_id(spark, folder):
    ids = ["DOC000000000003", "DOC000000000010", "DOC000000000042", "DOC000000000107", "DOC000000000199", "DOC-none"]
    return store.lookup(views.feed(spark, folder), ids).select(
        "story_id", "headline", "body_text", "source", "published_at", "language"
    )


@query
def filter_sources(spark, folder):
    return clean.filter_sources(views.feed(spark, folder), RULES.excluded_sources).select("story_id", "source_code")


@query
def category_search(spark, folder):
    articles = views.feed(spark, folder).withColumn("t", tagging.full_text(F.col("headline"), F.col("body_text")))
    hits = [
        F.when(tagging.category_search(F.col("t"), RULES.search_terms, cat, F.col("language"), "en"), F.lit(cat))
        for cat in [*RULES.search_terms, "UNDEFINED"]
    ]
    found = articles.select("story_id", F.explode_outer(F.array_compact(F.array(*hits))).alias("category"))
    return found.where(F.col("category").isNotNull())


@query
def filter_min_score(spark, folder):
    return ingest.filter_min_score(views.tagged(spark, folder), RULES).select(
        "story_id", "priority_score", "required_score"
    )


@query
def check_constraints(spark, folder):
    articles = _with_gaps(views.overlap(views.feed(spark, folder)))
    links = views.links(spark, folder)
    unlinked = views.feed(spark, folder).where("doc_id % 11 <> 0")
    events = views.events(spark, folder)
    return quality.constraint_report(
        quality.count_broken(
            articles,
            {
                "story_id_missing": text.is_blank(F.col("story_id")),
                "headline_missing": text.is_blank(F.col("headline")),
                "published_at_missing": F.col("published_at").isNull(),
            },
        ),
        quality.repeated_keys(articles, ["story_id"], "story_id_repeated"),
        quality.repeated_keys(links, ["story_id", "quality"], "link_repeated"),
        quality.orphans(links, unlinked, "story_id", "link_without_article"),
        quality.count_broken(
            events,
            {
                "status_outside_domain": quality.outside_domain("event_type", ("click", "view", "purchase", "signup")),
                "value_outside_decimal_3_2": quality.outside_decimal("value", 3, 2),
            },
        ),
    )


@query
def fill_defaults(spark, folder):
    documents, labels = (feeds.table(spark, folder, n) for n in ("documents", "labels"))
    joined = documents.join(labels, "doc_id", "left").select(
        "doc_id", "quality", "toxic", F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("language")
    )
    return clean.fill_defaults(joined, {"language": "en", "quality": 3, "toxic": 0})


# -- changes -------------------------------------------------------------------------------


@query
def update_by_key(spark, folder):
    articles = views.feed(spark, folder).select(
        "story_id", "headline", "published_at", F.col("published_at").alias("updated_at"), "doc_id"
    )
    path = _store_of(articles, "updated")
    updates = articles.where("doc_id % 7 = 0").select(
        F.when(F.col("doc_id") < 8, F.concat("story_id", F.lit("-none"))).otherwise(F.col("story_id")).alias("story_id"),
        F.concat(F.lit("Updated: "), "headline").alias("headline"),
        F.lit("ignored").alias("colour"),
    )
    store.apply_updates(spark, path, updates, views.as_of())
    return store.read_articles(spark, path).select("story_id", "headline", "updated_at")


@query
def delete_cascade(spark, folder):
    """Every eleventh article goes from a store, with its links; the rest is read back."""
    articles = views.feed(spark, folder)
    path, links = _store_of(articles, "deleted"), scratch_path(spark, "links")
    store.write_links(views.links(spark, folder), links)
    gone = store.apply_delete(spark, path, articles.where("doc_id % 11 = 0"), links)
    rows = [
        ("news_articles", store.read_articles(spark, path).count(), gone["articles_deleted"]),
        ("news_rics", store.read_links(spark, links).count(), gone["links_deleted"]),
    ]
    return spark.createDataFrame(rows, "table_name string, remaining long, deleted long")


@query
def retention_cleanup(spark, folder):
    cutoff = fields.hours_before(views.as_of(), 14 * 24)
    path = _event_store(spark, folder)
    deleted = store.retention_report(store.read_articles(spark, path), cutoff).first().deleted
    store.apply_retention(spark, path, cutoff)
    left = store.read_articles(spark, path)
    return left.agg(F.count("*").alias("kept"), F.lit(deleted).alias("deleted"), F.min("published_at").alias("oldest_kept"))


# -- joins ---------------------------------------------------------------------------------


def _with_pages(spark, folder):
    return feeds.enrich_bodies(views.feed(spark, folder), feeds.page_bodies(feeds.table(spark, folder, "pages")))


@query
def enrich_bodies(spark, folder):
    return _with_pages(spark, folder).select(
        "story_id", F.col("body_text").isNotNull().alias("has_body"), "body_text"
    )


@query
def exclude_seen(spark, folder):
    articles = views.feed(spark, folder)
    return dedup.exclude_seen(views.overlap(articles), _ids(articles, "doc_id % 2 = 0")).select(
        "story_id", "published_at"
    )


@query
def window_candidates(spark, folder):
    return dedup.window_candidates(views.feed(spark, folder), 24)


@query
def article_links(spark, folder):
    return store.linked(views.feed(spark, folder).select("story_id"), views.links(spark, folder)).select("story_id", "quality", "toxic")


# -- aggregates ----------------------------------------------------------------------------


@query
def stats_global(spark, folder):
    return _rounded(reports.stats_global(views.feed(spark, folder)), "avg_headline_length")


@query
def quality_daily(spark, folder):
    articles = views.feed(spark, folder).withColumns(
        {
            "created_at": F.col("published_at"),
            "headline": F.when(F.col("doc_id") % 19 != 0, F.col("headline")),
            "source": F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(F.col("source")),
        }
    )
    daily = _rounded(reports.quality_daily(articles), "avg_headline_length", "avg_body_length")
    return daily.withColumn("date", F.col("date").cast("string"))


@query
def stats_by_source_lang_cat(spark, folder):
    articles = views.tagged(spark, folder).withColumn("category", tagging.join_categories(F.col("categories")))
    return _rounded(reports.stats_by_source_lang_cat(articles), "avg_body_length")


@query
def latest_time(spark, folder):
    return reports.latest_time(views.events(spark, folder), "ts")


@query
def category_tag_counts(spark, folder):
    """Counts from the stored form, a comma-joined list with stray blanks."""
    joined = F.concat(F.array_join("categories", " , "), F.lit(","))
    stored = views.tagged(spark, folder).select(joined.alias("category"))
    return reports.category_tag_counts(stored.select(tagging.split_categories(F.col("category")).alias("categories")))


@query
def primary_category_counts(spark, folder):
    return reports.primary_category_counts(views.tagged(spark, folder))


@query
def language_counts(spark, folder):
    blanked = F.when(F.col("doc_id") % 8 == 0, F.lit("")).when(F.col("doc_id") % 8 != 1, F.col("language"))
    return reports.language_counts(views.feed(spark, folder).withColumn("language", blanked))


@query
def body_coverage(spark, folder):
    return _rounded(reports.body_coverage(_with_pages(spark, folder)), "body_rate")


@query
def top_sources(spark, folder):
    return reports.top_sources(views.feed(spark, folder), 10)


@query
def api_call_stats(spark, folder):
    calls = views.events(spark, folder).select(
        "ts", (F.col("event_type") != "error").alias("succeeded"), F.col("value").alias("seconds")
    )
    return _rounded(
        reports.api_call_stats(calls), "success_rate", "runtime_seconds", "calls_per_minute", "avg_response_ms"
    )


@query
def ingest_summary(spark, folder):
    return reports.ingest_summary(_by_category(spark, folder))


@query
def freshness_check(spark, folder):
    return _rounded(reports.freshness_check(_run_log(spark, folder), views.as_of()), "hours_since")


@query
def op_log_rollup(spark, folder):
    log = views.events(spark, folder).select(
        F.col("event_type").alias("operation"),
        F.concat(F.lit("table_"), (F.col("user_id") % 3).cast("string")).alias("table_name"),
        F.floor("value").alias("rows_affected"),
    )
    return reports.op_log_rollup(log)


# -- windows, sorts, set operations --------------------------------------------------------


@query
def dedup_keep_first(spark, folder):
    articles = views.overlap(views.feed(spark, folder))
    return dedup.keep_first(articles, "story_id", "arrival").select("story_id", "arrival", "published_at")


@query
def sample_per_category(spark, folder):
    sample = reports.sample_per_category(views.tagged(spark, folder), RULES.category_order)
    return sample.select("category", "rn", "story_id", "preview")


@query
def top_n_per_category(spark, folder):
    return reports.top_n_per_group(views.events(spark, folder), "event_type", 10, "ts", "event_id").select(
        "event_type", "rn", "event_id", "ts"
    )


def _feed_pages(spark, folder):
    rows = views.overlap(views.feed(spark, folder)).select("story_id", "published_at", "arrival")
    return paging.assign_pages(rows, 100, ties=("story_id", "arrival"))


@query
def page_running_totals(spark, folder):
    counts = paging.page_duplicate_counts(_feed_pages(spark, folder))
    return paging.page_running_totals(counts, "n_rows", "new_rows", "duplicates")


@query
def page_cursor(spark, folder):
    return paging.page_cursor(_feed_pages(spark, folder), _time("2024-01-01 12:00:00"))


@query
def page_duplicate_counts(spark, folder):
    return paging.page_duplicate_counts(_feed_pages(spark, folder))


@query
def order_by_priority(spark, folder):
    return ingest.order_by_priority(views.tagged(spark, folder))


@query
def union_pages_distinct(spark, folder):
    articles = views.feed(spark, folder).select("story_id", "doc_id")
    slices = [articles.where(F.col("doc_id") % 3 != i) for i in range(3)]
    united = dedup.union_distinct(slices, "story_id", "doc_id")
    return united.select("story_id", F.col("_page").alias("first_slice"))


# -- functions -----------------------------------------------------------------------------


@query
def html_to_text(spark, folder):
    return feeds.table(spark, folder, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query
def detect_categories(spark, folder):
    return views.tagged(spark, folder).select(
        "story_id", tagging.join_categories(F.col("categories")).alias("category")
    )


@query
def detect_urgency(spark, folder):
    return views.tagged(spark, folder).select("story_id", "urgency_level")


@query
def priority_score(spark, folder):
    return views.tagged(spark, folder).select("story_id", "priority_score")


@query
def normalize_source(spark, folder):
    code = F.when(F.col("doc_id") % 5 == 0, F.lit("NS:RTRS")).otherwise(F.col("source_code"))
    return views.feed(spark, folder).select("story_id", fields.normalize_source(code).alias("source"))


def _profiles(spark, folder):
    return language.language_profiles(feeds.table(spark, folder, "documents"), "text", "lang")


@query
def detect_language(spark, folder):
    """Profiles of the labelled texts, applied to the headlines."""
    articles = views.feed(spark, folder).select("story_id", "headline", "language")
    return language.detect_language(articles, _profiles(spark, folder)).select("story_id", "language", "detected")


@query
def mask_params(spark, folder):
    params = F.map_concat(
        F.from_json("props", "map<string,string>"),
        F.create_map(F.lit("Api_Key_Id"), F.concat(F.lit("key-"), F.col("event_id").cast("string"))),
    )
    masked = F.map_entries(fields.mask_params(params, ["api_key", "password", "token", "secret"]))
    shown = F.array_join(F.transform(masked, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return views.events(spark, folder).select("event_id", shown.alias("params"))


@query
def previous_day(spark, folder):
    start, end = fields.previous_day(_time("2024-01-16 10:30:00"))
    return clean.filter_date_range(views.events(spark, folder).select("event_id", "ts"), start, end, "ts")


# -- near duplicates -----------------------------------------------------------------------


@query
def headline_ngrams(spark, folder):
    terms = neardup.headline_ngrams(views.feed(spark, folder).select("story_id", "headline"))
    return terms.select(
        "story_id", F.size("terms").cast("bigint").alias("n_terms"), F.array_join("terms", "|").alias("terms")
    )


@query
def top_ngrams(spark, folder):
    return neardup.top_ngrams(neardup.headline_ngrams(views.feed(spark, folder).select("headline")))


@query
def tfidf_weights(spark, folder):
    return _rounded(neardup.tfidf_weights(views.feed(spark, folder)), "weight")


@query
def headline_cosine(spark, folder):
    return neardup.headline_cosine(views.feed(spark, folder))


@query
def near_duplicate_filter(spark, folder):
    return neardup.near_duplicates(views.feed(spark, folder))


# -- streams -------------------------------------------------------------------------------


def _event_stream(spark, folder):
    return streams.read_table_stream(spark, folder, "events", EVENT)


def _windows(counted: DataFrame, name: str, *by: str) -> DataFrame:
    window = counted.select(F.col("window.start").alias("window_start"), *by, "n")
    return streams.latest_counts(window, name).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_ingest(spark, folder):
    documents = streams.read_table_stream(spark, folder, "documents", DOCUMENT)
    rows = ingest_stream(feeds.documents_as_feed(documents), RULES).select(
        "story_id",
        "published_at",
        tagging.join_categories(F.col("categories")).alias("category"),
        "urgency_level",
        "priority_score",
    )
    return streams.loaded_new(rows, "stream_ingest", "story_id").withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))


@query
def stream_sliding_counts(spark, folder):
    events = streams.with_event_time(_event_stream(spark, folder), "ts")
    return _windows(streams.sliding_counts(events, "ts"), "sliding")


@query
def stream_daily_counts(spark, folder):
    events = streams.with_event_time(_event_stream(spark, folder), "ts")
    return _windows(streams.daily_counts(events, "ts", "event_type"), "daily", "event_type")


@query
def stream_dedup(spark, folder):
    events = _event_stream(spark, folder).select("event_id", "ts")
    arrivals = events.unionByName(_event_stream(spark, folder).select("event_id", "ts").where("event_id % 10 = 0"))
    kept = streams.loaded_new(arrivals, "dedup", "event_id")
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_late_data(spark, folder):
    """Two polls: every tenth event from before noon of January 15 arrives with the second; rows of closed hours are lost."""
    events = views.events(spark, folder).select("event_id", "ts")
    late = (F.col("ts") >= _time("2024-01-15 12:00:00")) | (F.col("event_id") % 10 == 0)
    path = scratch_path(spark, "late")
    source = f"{path}/source"
    for arrived in (events.where(~late), events.where(late)):
        arrived.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        counted = streams.hourly_counts(streams.with_event_time(stream, "ts"), "ts").select(F.col("window.start").alias("window_start"), "n")
        streams.upsert_counts(counted, f"{path}/table", f"{path}/checkpoint")
    counts = streams.read_counts(spark, f"{path}/table", counted.schema)
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_exclude_stored(spark, folder):
    stored = scratch_path(spark, "stored")
    streams.put_new(views.events(spark, folder).where("event_id % 2 = 0"), stored, "event_id")
    events = _event_stream(spark, folder).select("event_id", "ts")
    return streams.loaded_new(events, "exclude_stored", "event_id", stored=stored).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_load(spark, folder):
    """The feed as a stream into a store, with bodies and run log; the second run of the same stream stores nothing."""
    documents = streams.read_table_stream(spark, folder, "documents", DOCUMENT)
    bodies = feeds.page_bodies(feeds.table(spark, folder, "pages"))
    path, rules = scratch_path(spark, "stream_load"), replace(RULES, similarity=None)
    for _ in range(2):
        load_stream(feeds.documents_as_feed(documents), rules, f"{path}/store", f"{path}/checkpoint", as_of=views.as_of(), bodies=bodies)
    stored = store.read_articles(spark, f"{path}/store").select(
        "story_id", "published_at", tagging.join_categories(F.col("categories")).alias("category"), "priority_score",
        F.coalesce(F.length("body_text"), F.lit(0)).alias("body_length"),
    )
    return stored.withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))


@query
def stream_category_totals(spark, folder):
    return streams.running_totals(_event_stream(spark, folder), "event_type", "category_totals")


# -- jobs ----------------------------------------------------------------------------------


@query
def ingest_feed(spark, folder):
    """What the load of the feed stores beside every 25th article; :func:`pipeline_ingest` stores it."""
    feed = views.overlap(views.feed(spark, folder))
    stored = clean.truncate_headline(views.feed(spark, folder).where("doc_id % 25 = 0"))
    fresh = lambda articles: dedup.exclude_seen(articles, stored)
    chosen = ingest.new_articles(feed, RULES, fresh, stored, profiles=_profiles(spark, folder), arrival=("arrival",))
    return chosen.select(
        "story_id",
        "headline",
        "body_text",
        "source",
        "published_at",
        "language",
        tagging.join_categories(F.col("categories")).alias("category"),
        "urgency_level",
        "priority_score",
    )


def _stored_feed(spark, folder, name):
    """A store that holds every 25th article of the feed."""
    return _store_of(clean.truncate_headline(views.feed(spark, folder).where("doc_id % 25 = 0")), name)


@query
def pipeline_ingest(spark, folder):
    """Two loads of the feed, bodies from pages, and what store and run log then hold; the second one finds nothing new."""
    feed, bodies = views.overlap(views.feed(spark, folder)), feeds.page_bodies(feeds.table(spark, folder, "pages"))
    path = _stored_feed(spark, folder, "pipeline")
    for load in ("first", "second"):
        ingest.run_ingest(feed, RULES, path, views.as_of(), _profiles(spark, folder), bodies, arrival=("arrival",), load=load)
    stored = store.read_articles(spark, path).select(
        F.lit("article").alias("kind"), F.col("story_id").alias("id"), "language", tagging.join_categories(F.col("categories")).alias("category"),
        F.coalesce(F.length("body_text"), F.lit(-1)).cast("bigint").alias("size"), F.col("priority_score").cast("bigint").alias("score"),
    )
    log = runlog.read_log(spark, path).select(
        F.lit("run"), "run_id", "status", F.coalesce("error_message", F.lit("")), "articles_fetched", "articles_inserted"
    )
    return stored.where("size >= 0").union(log)


@query
def load_since_newest(spark, folder):
    """A store with the first half of the feed gets what is newer than its newest article."""
    feed = views.feed(spark, folder)
    middle = feed.agg(F.floor(F.max("doc_id") / 2)).scalar()
    path = _store_of(feed.where(F.col("doc_id") <= middle), "newest")
    before = store.read_articles(spark, path).select("story_id").count()
    counts = ingest.load_since_newest(feed, replace(RULES, similarity=None), path, views.as_of())
    after = store.read_articles(spark, path)
    return after.agg(F.count("*").alias("stored"), F.max("published_at").alias("newest")).select(
        F.lit(before).cast("bigint").alias("before"), F.lit(counts["articles_fetched"]).cast("bigint").alias("fetched"), "stored", "newest"
    )


@query
def load_by_category(spark, folder):
    """The newest 50 articles of each category go into a store that holds every 25th article."""
    path = _stored_feed(spark, folder, "categories")
    return ingest.load_by_category(views.feed(spark, folder), replace(RULES, similarity=None), path, views.as_of(), 50)


@query
def backfill_pages(spark, folder):
    """A range loaded in pages of 200, its first page before a restart; what is stored, and the runs."""
    start, end = map(_time, RANGE)
    path, rules, feed = scratch_path(spark, "backfill"), replace(RULES, similarity=None), views.feed(spark, folder)
    pages = [ingest.backfill(feed, rules, path, views.as_of(), start, end, 200) for _ in range(2)]
    runs = runlog.read_log(spark, path).agg(F.count("*").alias("runs"), F.sum("articles_fetched").alias("fetched"), F.sum("articles_inserted").alias("inserted"))
    stored = store.read_articles(spark, path).agg(F.count("*").alias("stored"), F.min("published_at").alias("oldest"))
    return runs.join(stored).select("runs", "fetched", "inserted", "stored", "oldest", F.lit(pages[1]).cast("bigint").alias("pages_again"))


@query
def category_report(spark, folder):
    articles = ingest.tag_articles(_with_pages(spark, folder), RULES)
    return reports.category_report(articles, RULES.category_order)


@query
def weekly_maintenance(spark, folder):
    cutoff = fields.hours_before(views.as_of(), 14 * 24)
    return maintenance.weekly_maintenance(spark, _event_store(spark, folder), cutoff)
