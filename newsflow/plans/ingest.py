"""The ingest job: feed rows in, new enriched articles out."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import tagging
from newsflow.functions.text import compute_once
from newsflow.operators import clean, dedup, language, neardup
from newsflow.operators.ordered import number_rows
from newsflow.rules import Rules
from newsflow.session import cut, scratch_path
from newsflow.sources import commits, runlog, store
from newsflow.sources import feed as feeds

_FIRST_PUBLISHED = ("published_at", "headline")


def tag_articles(articles: DataFrame, rules: Rules, requested: str | None = None) -> DataFrame:
    """Add ``categories``, ``urgency_level`` and ``priority_score``. No shuffle."""
    text, headline = F.col("_text"), F.col("headline")
    whole = articles.withColumn("_text", tagging.full_text(headline, F.col("body_text")))
    return compute_once(
        whole,
        {
            "categories": tagging.detect_categories(
                text, headline, rules.category_words, rules.headline_phrases, requested
            ),
            "urgency_level": tagging.detect_urgency(text, rules.urgency_words),
            "priority_score": tagging.priority_score(text, rules.priority_terms),
        },
    ).drop("_text")


def filter_min_score(scored: DataFrame, rules: Rules) -> DataFrame:
    """Articles that reach the highest minimum of their categories, then the overall one."""
    scored = scored.withColumn("required_score", tagging.required_score(F.col("categories"), rules.category_minimum))
    scored = scored.where(F.col("priority_score") >= F.col("required_score"))
    return scored.where(F.col("priority_score") >= rules.minimum_score) if rules.minimum_score > 0 else scored


def order_by_priority(scored: DataFrame) -> DataFrame:
    """``rank`` of all articles by score. A sort reads its input more than once, so the scores are kept first."""
    narrow = cut(scored.select("story_id", "priority_score"))
    return number_rows(narrow, F.desc("priority_score"), F.asc("story_id"), name="rank")


def normalized(feed: DataFrame, rules: Rules) -> DataFrame:
    """Valid articles; ``row_hash`` tells the arrivals of one story apart."""
    articles = clean.truncate_headline(clean.normalize_articles(feed), rules.max_headline_length)
    return articles.withColumn("row_hash", F.xxhash64(*[F.col(c) for c in articles.columns]))


def selected(
    feed: DataFrame,
    rules: Rules,
    bodies: DataFrame | None = None,
    requested: str | None = None,
    arrival: tuple[str, ...] = _FIRST_PUBLISHED,
    fresh: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Valid, tagged and scored articles of a feed, one per story, with their texts.

    Of a story's arrivals only the first of each task travels. Bodies are joined on the same key. ``fresh`` leaves out
    stories by their id, before anything costly is done to them.
    """
    articles = dedup.keep_first(normalized(feed, rules), "story_id", *arrival, "row_hash")
    articles = clean.filter_sources(articles, rules.excluded_sources)
    if fresh is not None:
        articles = fresh(articles)
    if bodies is not None:
        articles = feeds.enrich_bodies(articles, bodies)
    return filter_min_score(tag_articles(articles, rules, requested), rules).drop("row_hash")


def window_of(stored: DataFrame, articles: DataFrame, hours: int) -> DataFrame:
    """Stored headlines that can have a near-duplicate among ``articles``."""
    first, last = articles.agg(F.min("published_at"), F.max("published_at")).first()
    if first is None:
        return stored.where("false").select("story_id", "headline", "published_at")
    since = first - timedelta(hours=hours)
    near = clean.filter_date_range(stored, since, last)
    if "published_date" in stored.columns:
        near = clean.filter_date_range(near, since.date(), last.date(), "published_date")
    return near.select("story_id", "headline", "published_at")


def new_articles(
    feed: DataFrame,
    rules: Rules,
    fresh: Callable[[DataFrame], DataFrame],
    stored: DataFrame,
    profiles: DataFrame | None = None,
    bodies: DataFrame | None = None,
    requested: str | None = None,
    arrival: tuple[str, ...] = _FIRST_PUBLISHED,
) -> DataFrame:
    """The articles of a feed that a store should get.

    ``fresh`` leaves out stored stories; near-duplicates of earlier articles go too, and the window of an article also
    covers what is ``stored``. Articles are written once, in hash buckets of their id, so that texts do not travel
    again when the ids to keep are known.
    """
    spark, path = feed.sparkSession, scratch_path(feed.sparkSession, "articles")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    articles = commits.bucketed(selected(feed, rules, bodies, requested, arrival, fresh), path, "story_id", buckets)
    chosen = articles
    if rules.similarity is not None:
        headlines = articles.select("story_id", "headline", "published_at")
        compared = window_of(stored, articles, rules.window_hours).unionByName(headlines)
        found = neardup.near_duplicates(compared, rules.window_hours, rules.similarity).where("is_duplicate")
        found = cut(found.select("story_id")).repartition(buckets, "story_id")
        chosen = dedup.exclude_seen(articles, found)
    if profiles is not None:
        chosen = language.detect_language(chosen.drop("language"), profiles).withColumnRenamed("detected", "language")
    return clean.fill_defaults(chosen)


def run_ingest(
    feed: DataFrame,
    rules: Rules,
    path: str,
    as_of: Column,
    profiles: DataFrame | None = None,
    bodies: DataFrame | None = None,
    requested: str | None = None,
    arrival: tuple[str, ...] = _FIRST_PUBLISHED,
    load: str | None = None,
) -> dict[str, int]:
    """Load a feed into the store at ``path`` and count fetched, inserted and failed rows.

    The store's run log gets a ``running`` row before and the last one after, also if the load fails. A feed without
    rows is a failed run. A ``load`` of a name that is stored already does nothing.
    """
    spark, run_id = feed.sparkSession, load or uuid.uuid4().hex
    nothing = {"articles_fetched": 0, "articles_inserted": 0, "articles_failed": 0}
    if load is not None and commits.loaded(spark, path, load):
        return nothing
    runlog.open_run(spark, path, run_id, as_of)
    try:
        keys = commits.batch_keys(clean.canonical(feed), "story_id")  # of all rows: one pass counts them and looks them up
        fetched = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
        if not fetched:
            runlog.close_run(spark, path, run_id, as_of, "no articles fetched")
            return nothing
        stored = store.read_articles(spark, path)
        rows = new_articles(feed, rules, lambda df: store.not_stored(df, path, keys), stored, profiles, bodies, requested, arrival)
        rows = rows.withColumns({"created_at": as_of, "updated_at": as_of})
        inserted = store.append_articles(rows, path, run_id)
    except Exception as failure:
        runlog.close_run(spark, path, run_id, as_of, f"{type(failure).__name__}: {str(failure)[:500]}")
        raise
    runlog.close_run(spark, path, run_id, as_of, articles_fetched=fetched, articles_inserted=inserted, api_calls=1)
    return {"articles_fetched": fetched, "articles_inserted": inserted, "articles_failed": fetched - inserted}


def load_since_newest(feed: DataFrame, rules: Rules, path: str, as_of: Column, **settings) -> dict[str, int]:
    """:func:`run_ingest` of what is newer than the newest stored article, or of the last 24 hours."""
    articles = clean.canonical(feed)
    newer = store.since_high_water(articles, store.read_articles(feed.sparkSession, path), as_of)
    return run_ingest(newer, rules, path, as_of, **settings)


def load_by_category(feed: DataFrame, rules: Rules, path: str, as_of: Column, newest: int, **settings) -> DataFrame:
    """Load the ``newest`` articles that each category's search finds; the first category stores a shared story.

    Returns ``category, fetched, stored, failed, duplicate_of_category`` as of what the store then holds. The newest of
    each category are chosen before the shuffle; one load stores them all.
    """
    spark = feed.sparkSession
    articles = clean.canonical(feed)
    searched = articles.withColumn("_text", tagging.full_text(F.col("headline"), F.col("body_text")))
    matched = compute_once(searched, {"_found": tagging.searched_categories(F.col("_text"), rules.search_terms)})
    narrow = matched.select("story_id", "published_at", F.posexplode("_found").alias("_at", "category"))
    order = {c: i for i, c in enumerate(rules.search_terms)}
    first = Window.partitionBy("category").orderBy(F.desc("published_at"), "story_id")
    wanted = narrow.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= newest)
    place = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("category")]
    wanted = cut(dedup.keep_first(wanted.select("story_id", "category", place.alias("place")), ["story_id", "category"], "place"))
    known = cut(store.lookup(store.read_articles(spark, path), wanted.select("story_id").distinct()).select("story_id"))
    run_ingest(articles.join(wanted.select("story_id").distinct(), "story_id", "left_semi"), rules, path, as_of, **settings)
    new = store.lookup(store.read_articles(spark, path), wanted.select("story_id").distinct()).select("story_id")
    new = dedup.exclude_seen(new, known).withColumn("new", F.lit(True))
    told = wanted.join(new, "story_id", "left").withColumn("nth", F.row_number().over(Window.partitionBy("story_id").orderBy("place")))
    fetched, stored_ = F.count("*").alias("fetched"), F.count_if(F.col("new") & (F.col("nth") == 1)).alias("stored")
    counts = told.groupBy("category").agg(fetched, stored_, F.count_if(F.col("new") & (F.col("nth") > 1)).alias("duplicate_of_category"))
    return counts.select("category", "fetched", "stored", (F.col("fetched") - F.col("stored")).alias("failed"), "duplicate_of_category")


def backfill(feed: DataFrame, rules: Rules, path: str, as_of: Column, start, end, per_page: int, name: str = "backfill", **settings) -> int:
    """Load the articles of a range page by page, newest first; a restart goes on after the last stored page.

    Pages are cut by the order of time and id over the whole range, so that they are the same each time; each one is a
    load of its own name, which is not repeated. Returns the number of pages loaded.
    """
    spark = feed.sparkSession
    articles = clean.filter_date_range(clean.canonical(feed), start, end)
    ordered = number_rows(articles.select("story_id", "published_at"), F.desc("published_at"), "story_id", name="_n")
    page = F.floor((F.col("_n") - 1) / per_page)
    pages = cut(ordered.select("story_id", page.alias("_page")).groupBy("story_id").agg(F.min("_page").alias("_page")))
    last, done = pages.agg(F.max("_page")).first()[0], 0
    for number in range(0 if last is None else last + 1):
        load = f"{name}-{number:08d}"
        if not commits.loaded(spark, path, load):
            run_ingest(articles.join(pages.where(F.col("_page") == number), "story_id", "left_semi"), rules, path, as_of, load=load, **settings)
            done += 1
    return done
