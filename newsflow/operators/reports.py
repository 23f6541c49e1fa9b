"""Reports over stored articles, calls and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions.fields import micros, response_ms
from newsflow.functions.tagging import join_categories
from newsflow.functions.text import preview
from newsflow.operators.ordered import last_before
from newsflow.session import cut


def register_views(articles: DataFrame) -> None:
    """Temporary views over stored articles: the table itself, its quality by day, its statistics."""
    articles = articles.withColumn("category", join_categories(F.col("categories")))
    articles.createOrReplaceTempView("news_articles")
    quality_daily(articles).createOrReplaceTempView("news_quality_check")
    stats_by_source_lang_cat(articles).createOrReplaceTempView("news_statistics")


def _empty(col: str) -> Column:
    return F.col(col).isNull() | (F.col(col) == "")


def stats_global(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.count("*").alias("total_articles"),
        F.countDistinct("source").alias("sources_count"),
        F.max("published_at").alias("latest_article"),
        F.min("published_at").alias("earliest_article"),
        F.avg(F.length("headline")).alias("avg_headline_length"),
    )


def quality_daily(articles: DataFrame, time: str = "created_at") -> DataFrame:
    """Missing values and text lengths per day of ``time``, newest day first."""
    return (
        articles.groupBy(F.to_date(time).alias("date"))
        .agg(
            F.count("*").alias("total_articles"),
            F.count_if(_empty("headline")).alias("missing_headline"),
            F.count_if(F.col("published_at").isNull()).alias("missing_published_at"),
            F.count_if(_empty("source")).alias("missing_source"),
            F.avg(F.length("headline")).alias("avg_headline_length"),
            F.avg(F.length("body_text")).alias("avg_body_length"),
        )
        .orderBy(F.desc("date"))
    )


def stats_by_source_lang_cat(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy("source", "language", "category")
        .agg(
            F.count("*").alias("article_count"),
            F.min("published_at").alias("earliest_article"),
            F.max("published_at").alias("latest_article"),
            F.avg(F.length("body_text")).alias("avg_body_length"),
        )
        .orderBy(F.desc("article_count"), "source", "language", "category")
    )


def latest_time(articles: DataFrame, time: str = "published_at") -> DataFrame:
    return articles.agg(F.max(time).alias("latest_time"))


def category_tag_counts(articles: DataFrame, categories: str = "categories") -> DataFrame:
    """Articles per tag; an article counts for each of its tags."""
    tags = articles.select(F.explode(categories).alias("category"))
    return tags.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def primary_category_counts(articles: DataFrame, categories: str = "categories") -> DataFrame:
    """Articles per first tag."""
    first = articles.select(F.get(categories, F.lit(0)).alias("category")).where(F.col("category").isNotNull())
    return first.groupBy("category").agg(F.count("*").alias("n")).orderBy("category")


def language_counts(articles: DataFrame) -> DataFrame:
    language = F.when(_empty("language"), F.lit("unknown")).otherwise(F.col("language"))
    return articles.groupBy(language.alias("language")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language")


def body_coverage(articles: DataFrame) -> DataFrame:
    """Articles with and without a body, and the percentage with one (0 if there are none)."""
    has_body = F.coalesce(F.length("body_text") > 0, F.lit(False))
    total = F.count("*")
    return articles.agg(
        F.count_if(has_body).alias("with_body"),
        F.count_if(~has_body).alias("without_body"),
        F.when(total > 0, 100 * F.count_if(has_body) / total).otherwise(F.lit(0.0)).alias("body_rate"),
    )


def top_sources(articles: DataFrame, k: int = 10) -> DataFrame:
    source = F.when(_empty("source"), F.lit("unknown")).otherwise(F.col("source"))
    counts = articles.groupBy(source.alias("source")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "source").limit(k)


def sample_per_category(articles: DataFrame, categories: list[str], k: int = 3, length: int = 60) -> DataFrame:
    """The first ``k`` articles of each first tag, tags in the given order."""
    first = F.get("categories", F.lit(0))
    tagged = articles.select(first.alias("category"), "published_at", "story_id", "headline").where(
        F.col("category").isin(categories)
    )
    rn = F.row_number().over(Window.partitionBy("category").orderBy("published_at", "story_id"))
    rank = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    return (
        tagged.withColumn("rn", rn)
        .where(F.col("rn") <= k)
        .withColumn("preview", preview(F.col("headline"), length))
        .withColumn("category_rank", rank)
        .orderBy("category_rank", "rn")
    )


def top_n_per_group(df: DataFrame, group: str, n: int, time: str, key: str) -> DataFrame:
    """The newest ``n`` rows of each group. Spark keeps only ``n`` per group and partition before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(time), key))
    return df.withColumn("rn", rn).where(F.col("rn") <= n)


def api_call_stats(calls: DataFrame) -> DataFrame:
    """Totals, success rate, runtime and call rate of ``calls`` (``ts, succeeded, seconds``)."""
    total, errors = F.count("*"), F.count_if(~F.col("succeeded"))
    runtime = F.coalesce((F.max(micros(F.col("ts"))) - F.min(micros(F.col("ts")))) / 1_000_000, F.lit(0.0))
    return calls.agg(
        total.alias("total_calls"),
        errors.alias("error_count"),
        ((total - errors) / F.greatest(total, F.lit(1))).alias("success_rate"),
        runtime.alias("runtime_seconds"),
        F.when(runtime > 0, total / F.greatest(runtime / 60, F.lit(1.0))).otherwise(F.lit(0.0)).alias("calls_per_minute"),
        F.avg(response_ms(F.col("seconds"))).alias("avg_response_ms"),
    )


def ingest_summary(by_category: DataFrame) -> DataFrame:
    """Counts per category and their total (``ALL``) in one pass."""
    sums = by_category.groupingSets([["category"], []], "category").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("fetched", "stored", "failed")],
        F.grouping("category").alias("_total"),
    )
    label = F.when(F.col("_total") == 1, F.lit("ALL")).otherwise(F.col("category"))
    return sums.select(
        label.alias("category"), "fetched", "stored", "failed", (F.col("fetched") > 0).alias("success")
    )


def freshness_check(log: DataFrame, as_of: Column, stale_hours: int = 2) -> DataFrame:
    """Time since the last completed run, and how many gaps in the log were too long."""
    done = log.where("status = 'completed'").select(micros(F.col("fetch_end")).alias("at"), "run_id", F.lit(1).alias("all"))
    gaps = last_before(done, ["all"], ["at", "run_id"], {"previous": "at"})
    limit = stale_hours * 3_600_000_000
    now = micros(as_of)
    since = now - F.max("at")
    return gaps.agg(
        F.max("at").alias("last"),
        (since / 3_600_000_000).alias("hours_since"),
        F.coalesce(since > limit, F.lit(True)).alias("is_stale"),
        F.count_if(F.col("at") - F.col("previous") > limit).alias("n_gaps"),
    ).select(
        as_of.alias("as_of"),
        F.timestamp_micros("last").cast("timestamp_ntz").alias("last_success"),
        "hours_since",
        "is_stale",
        "n_gaps",
    )


def op_log_rollup(log: DataFrame) -> DataFrame:
    """Queries and affected rows per operation and table."""
    return log.groupBy("operation", "table_name").agg(
        F.count("*").alias("query_count"), F.sum("rows_affected").alias("rows_affected")
    )


def category_report(articles: DataFrame, categories: list[str], top: int = 10) -> DataFrame:
    """Counts by tag, first tag, language, body and source, as ``section, key, value``.

    Texts are read once. Every article names the counters it adds to, so one
    small aggregate serves all sections.
    """
    has_body = F.coalesce(F.length("body_text") > 0, F.lit(False))
    narrow = ["categories", "language", "source", "published_at", "story_id", "headline"]
    articles = cut(articles.select(*narrow, has_body.alias("has_body")))
    first = F.get("categories", F.lit(0))

    def counter(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.alias("key"))

    counters = F.concat(
        F.transform("categories", lambda c: counter("category_tag", c)),
        F.array(
            counter("total", F.lit("articles")),
            counter("primary_category", first),
            counter("language", F.when(_empty("language"), F.lit("unknown")).otherwise(F.col("language"))),
            counter("body", F.when(F.col("has_body"), F.lit("with_body")).otherwise(F.lit("without_body"))),
            counter("source", F.when(_empty("source"), F.lit("unknown")).otherwise(F.col("source"))),
        ),
    )
    counts = (
        articles.select(F.inline_outer(counters))
        .where(F.col("key").isNotNull())
        .groupBy("section", "key")
        .agg(F.count("*").alias("n"))
    )
    plain = counts.where(F.col("section") != "source")
    sources = counts.where(F.col("section") == "source").orderBy(F.desc("n"), "key").limit(top)
    rate = counts.where(F.col("section") == "body").agg(
        F.coalesce(100 * F.sum(F.when(F.col("key") == "with_body", F.col("n"))) / F.sum("n"), F.lit(0.0)).alias("r")
    )
    samples = sample_per_category(articles, categories)
    return (
        plain.unionByName(sources)
        .select("section", "key", F.col("n").cast("string").alias("value"))
        .unionByName(
            rate.select(
                F.lit("body").alias("section"), F.lit("body_rate").alias("key"), F.round("r", 1).cast("string").alias("value")
            )
        )
        .unionByName(
            samples.select(
                F.lit("sample").alias("section"),
                F.concat_ws("#", "category", F.col("rn").cast("string")).alias("key"),
                F.col("preview").alias("value"),
            )
        )
    )
