"""The article store: Parquet partitioned by ``published_date``, one row per ``story_id``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.fields import hours_before, micros, plus_seconds
from newsflow.operators.clean import fill_defaults, filter_date_range
from newsflow.operators.dedup import keep_first
from newsflow.schema import STORED_ARTICLE
from newsflow.session import cut
from newsflow.sources import commits

DEFAULT_COUNT = 100


# -- reads ---------------------------------------------------------------------------------


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The stored articles; an empty table where nothing is stored yet.

    Columns that older files lack, and values that are missing, have the defaults
    of the store. The schema is given, so no file is opened to find it.
    """
    commits.recover(spark, path)
    if not stored_folders(spark, path):
        return spark.createDataFrame([], STORED_ARTICLE)
    return fill_defaults(spark.read.schema(STORED_ARTICLE).parquet(path))


def scan_latest(
    articles: DataFrame,
    count: int | None = None,
    start=None,
    end=None,
    predicate: Column | None = None,
    max_count: int | None = None,
) -> DataFrame:
    """The newest ``count`` rows of a range; a count above the caller's ``max_count`` is an error."""
    count = DEFAULT_COUNT if count is None else count
    if max_count is not None and count > max_count:
        raise ValueError(f"{count} rows asked for, {max_count} allowed")
    articles = filter_date_range(articles, start, end)
    if predicate is not None:
        articles = articles.where(predicate)
    return articles.orderBy(F.desc("published_at"), "story_id").limit(count)


def backfill_range(articles: DataFrame, start, end, *arrival: str) -> DataFrame:
    """All rows of a range, newest first, one per story."""
    found = keep_first(filter_date_range(articles, start, end), "story_id", *arrival)
    return found.orderBy(F.desc("published_at"), "story_id")


def load_range_forward(articles: DataFrame, start, end, *arrival: str) -> DataFrame:
    """The same rows as :func:`backfill_range`, oldest first."""
    found = keep_first(filter_date_range(articles, start, end), "story_id", *arrival)
    return found.orderBy("published_at", "story_id")


def since_high_water(source: DataFrame, store: DataFrame, as_of: Column, time: str = "published_at") -> DataFrame:
    """Rows from one second after the newest stored one; the last 24 hours if the store is empty."""
    start = store.agg(F.coalesce(plus_seconds(F.max(time), 1), hours_before(as_of, 24)).alias("start")).scalar()
    return source.where(F.col(time) >= start)


def lookup(articles: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    """Articles of the given ids: a list, or a table with ``story_id``."""
    if isinstance(ids, DataFrame):
        return articles.join(ids.select("story_id"), "story_id", "left_semi")
    return articles.where(F.col("story_id").isin(ids))


def linked(articles: DataFrame, links: DataFrame) -> DataFrame:
    """Each article with each of its links."""
    return articles.join(links, "story_id")


def with_link(articles: DataFrame, links: DataFrame) -> DataFrame:
    """Articles that have a link, once each."""
    return lookup(articles, links)


def evolve_add_column(older: DataFrame, newer: DataFrame, column: str, default) -> DataFrame:
    """Rows from before and after a column was added, with the default where it is missing."""
    together = older.unionByName(newer, allowMissingColumns=True)
    return together.withColumn(column, F.coalesce(column, F.lit(default)))


# -- inserts -------------------------------------------------------------------------------


def new_rows(batch: DataFrame, store: DataFrame, *arrival: str) -> DataFrame:
    """Rows to store: first arrival of each story that is not stored. First writer wins."""
    return keep_first(batch, "story_id", *arrival).join(store.select("story_id"), "story_id", "left_anti")


def ingest_counts(batch: DataFrame, store: DataFrame) -> DataFrame:
    """Rows processed, inserted and failed; repeats and stored stories count as failed."""
    stories = batch.groupBy("story_id").agg(F.count("*").alias("n"))
    stored = store.select("story_id", F.lit(True).alias("stored"))
    return (
        stories.join(stored, "story_id", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_processed"),
            F.count_if(F.col("stored").isNull()).alias("inserted_count"),
        )
        .withColumn("failed_count", F.col("total_processed") - F.col("inserted_count"))
    )


def append_articles(rows: DataFrame, path: str, load: str | None = None) -> int:
    """Append the columns of the store, partitioned by date; large dates are split over tasks, small ones joined.

    Returns the number of rows written.
    """
    return commits.change(rows.sparkSession, path, by_date(_dated(rows)), _BY, ids=_ids, load=load)


_BY = ("published_date",)


def _dated(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("published_date", F.to_date("published_at"))
    return rows.select(*[c for c in STORED_ARTICLE.names if c in rows.columns])


def _ids(rows: DataFrame, stored: bool = True) -> DataFrame:
    return rows.select(F.col("story_id").alias("key"), F.col("published_at").alias("time"), F.lit(stored).alias("stored"))


def by_date(rows: DataFrame) -> DataFrame:
    """Rows brought together by date for writing, in partitions of even size."""
    return rows.hint("rebalance", "published_date")


def not_stored(batch: DataFrame, path: str, keys: DataFrame | None = None) -> DataFrame:
    """Articles of a batch that the store does not hold, by its index of ids."""
    return commits.not_stored(batch, path, "story_id", _ids(read_articles(batch.sparkSession, path)).drop("stored"), keys)


def insert_only(batch: DataFrame, path: str, *arrival: str, as_of=None, load: str | None = None) -> dict[str, int]:
    """Store the new stories of a batch and count them. A repeated call stores nothing."""
    keys = commits.batch_keys(batch, "story_id")
    rows = not_stored(keep_first(batch, "story_id", *arrival), path, keys)
    if as_of is not None:
        rows = rows.withColumns({"created_at": F.lit(as_of), "updated_at": F.lit(as_of)})
    inserted = append_articles(rows, path, load)
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    return {"total_processed": total, "inserted_count": inserted, "failed_count": total - inserted}


def ingest_by_category(matched: DataFrame, store: DataFrame, categories: str = "categories") -> DataFrame:
    """Fan-out load: each category fetches its stories, the first one stores a shared story.

    ``matched`` has one row per story with its categories in load order. One
    pass counts all categories: fetched, stored, failed, and how many of the
    failed an earlier category had stored.
    """
    known = matched.select("story_id", F.col(categories).alias("c")).join(
        store.select("story_id", F.lit(True).alias("stored")), "story_id", "left"
    )
    fetched = known.select("stored", F.posexplode_outer("c").alias("pos", "category")).where("category IS NOT NULL")
    return (
        fetched.groupBy("category")
        .agg(
            F.count("*").alias("fetched"),
            F.count_if((F.col("pos") == 0) & F.col("stored").isNull()).alias("stored"),
            F.count_if((F.col("pos") > 0) & F.col("stored").isNull()).alias("duplicate_of_category"),
        )
        .select(
            "category", "fetched", "stored", (F.col("fetched") - F.col("stored")).alias("failed"), "duplicate_of_category"
        )
    )


# -- changes -------------------------------------------------------------------------------


def update_by_key(articles: DataFrame, updates: DataFrame, as_of: Column, *order: Column | str) -> DataFrame:
    """Articles with the given columns changed, also to NULL, and ``updated_at`` set.

    Columns that articles do not have are ignored, as are unknown stories. Of several
    updates for one story the first in ``order`` counts (without one, that of the
    smallest row hash). A changed ``published_at`` changes ``published_date``.
    """
    own = ("story_id", "updated_at", "published_date")
    changed = [c for c in updates.columns if c in articles.columns and c not in own]
    updates = keep_first(updates, "story_id", *order)
    new = updates.select("story_id", *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit"))
    joined = articles.join(new, "story_id", "left")
    hit = F.col("_hit").isNotNull()
    joined = joined.withColumns({c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in changed})
    joined = joined.withColumn("updated_at", F.when(hit, as_of).otherwise(F.col("updated_at")))
    if "published_date" in articles.columns:
        joined = joined.withColumn("published_date", F.to_date("published_at"))
    return joined.select(*articles.columns)


def apply_updates(spark: SparkSession, path: str, updates: DataFrame, as_of: Column, *order: Column | str) -> None:
    """Update the store in place: only dates that an updated story leaves or enters are rewritten.

    The new files of all touched dates are staged first, so that a run that breaks off between
    two dates is finished by the next one.
    """
    stored = read_articles(spark, path)
    hits = stored.join(updates.select("story_id").distinct(), "story_id", "left_semi")
    new = cut(update_by_key(hits, updates, as_of, *order).select("story_id", "published_at", "published_date"))
    dates = cut(hits.select("published_date").union(new.select("published_date")).distinct())
    _rewrite(spark, path, lambda touched: update_by_key(touched, updates, as_of, *order), _collected(dates), _ids(new))


def _collected(dates: DataFrame) -> list[date | None]:
    """Dates of a narrow table; as many as the store has folders at most."""
    return [r.published_date for r in dates.toLocalIterator()]


def _folder(day: date | None) -> str:
    return f"published_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def _rewrite(spark: SparkSession, path: str, changed, days: list, ids: DataFrame) -> None:
    """The rows of ``days`` become ``changed`` of them, in one change of the store; files of other dates stay."""
    if not days:
        return
    dates = ", ".join(f"DATE'{d}'" for d in days if d is not None)  # one expression, not one for each date
    touched = F.expr(f"published_date IN ({dates})") if dates else F.lit(False)
    if None in days:
        touched = F.coalesce(touched, F.lit(False)) | F.col("published_date").isNull()
    folders = {_folder(d) for d in days}
    old = [f for f in commits.data_files(spark, path) if f.split("/")[0] in folders]
    rows = changed(read_articles(spark, path).where(touched))
    commits.change(spark, path, by_date(rows), _BY, replaces=old, ids=ids)


def delete_by_key(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys.select("story_id"), "story_id", "left_anti")


def delete_cascade(articles: DataFrame, links: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles without the keys, and links without the articles that went."""
    gone = articles.join(keys.select("story_id"), "story_id", "left_semi")
    return delete_by_key(articles, keys), delete_by_key(links, gone)


def delete_report(articles: DataFrame, links: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows deleted from and left in both tables."""
    wanted = keys.select("story_id").distinct()
    gone = wanted.join(articles.select("story_id"), "story_id", "left_semi")

    def count(table: DataFrame, deleted: DataFrame, name: str) -> DataFrame:
        return (
            table.select("story_id")
            .join(deleted.withColumn("gone", F.lit(True)), "story_id", "left")
            .agg(
                F.count_if(F.col("gone").isNull()).alias("remaining"),
                F.count_if(F.col("gone")).alias("deleted"),
            )
            .select(F.lit(name).alias("table_name"), "remaining", "deleted")
        )

    return count(articles, wanted, "news_articles").unionByName(count(links, gone, "news_rics"))


def retain(df: DataFrame, cutoff: Column, time: str = "published_at") -> DataFrame:
    """Rows at or after the cutoff."""
    return df.where(F.col(time) >= cutoff)


def retention_report(df: DataFrame, cutoff: Column, time: str = "published_at") -> DataFrame:
    kept = F.col(time) >= cutoff
    return df.agg(
        F.count_if(kept).alias("kept"),
        F.count_if(F.col(time) < cutoff).alias("deleted"),
        F.min(F.when(kept, F.col(time))).alias("oldest_kept"),
    )


def stored_folders(spark: SparkSession, path: str) -> list[str]:
    return sorted({f.split("/")[0] for f in commits.data_files(spark, path) if f.startswith("published_date=")})


def stored_dates(spark: SparkSession, path: str) -> list[date]:
    """The dates that have rows in the store, oldest first; no file is opened.

    Rows without a time lie in a folder of their own, which is not listed.
    """
    days = [n.removeprefix("published_date=") for n in stored_folders(spark, path)]
    return sorted(date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__")


def apply_retention(spark: SparkSession, path: str, cutoff: Column) -> None:
    """Drop the rows before ``cutoff`` from the store in place.

    Folders of whole dates before it go unread, and only the date of the cutoff is
    rewritten. Rows without a time stay. A repeated call changes nothing.
    """
    boundary, micros_ = spark.range(1).select(F.to_date(cutoff), micros(cutoff)).first()
    commits.recover(spark, path)
    commits.note_dropped(spark, path, micros_)
    for day in stored_dates(spark, path):
        if day < boundary:
            commits.remove(spark, f"{path}/{_folder(day)}")
        elif day == boundary:
            held = read_articles(spark, path).where(F.col("published_date") == boundary)
            gone = held.where(~(F.col("published_at") >= cutoff))
            if not gone.isEmpty():
                _rewrite(spark, path, lambda rows: retain(rows, cutoff), [day], _ids(gone, stored=False))


LINK_PARTS = 64


def write_links(links: DataFrame, path: str) -> None:
    """Append to a table of links, hash-partitioned by ``story_id``."""
    commits.change(links.sparkSession, path, _parted(links), ("part",))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    commits.recover(spark, path)
    return spark.read.parquet(path).drop("part")


def _parted(links: DataFrame) -> DataFrame:
    return links.withColumn("part", F.pmod(F.xxhash64("story_id"), F.lit(LINK_PARTS))).hint("rebalance", "part")


def apply_delete(spark: SparkSession, path: str, keys: DataFrame, links_path: str | None = None) -> dict[str, int]:
    """Delete stories from the store in place, with their links, and count the rows that went.

    Only dates that hold a deleted story are rewritten, and only the touched parts of the table of links, if
    :func:`write_links` wrote it (another Parquet table with ``story_id`` is rewritten as a whole). Both are
    changes that a later call finishes if they break off. Unknown stories delete nothing. Links go
    first, so that a repeated call finds what is left.
    """
    stored = read_articles(spark, path)
    gone = cut(stored.join(keys.select("story_id").distinct(), "story_id", "left_semi").select("story_id", "published_at", "published_date"))
    counts = {"articles_deleted": gone.count(), "links_deleted": 0}
    if links_path is not None and commits.exists(spark, links_path):
        counts["links_deleted"] = _delete_links(spark, links_path, gone)
    days = _collected(gone.select("published_date").distinct())
    _rewrite(spark, path, lambda rows: delete_by_key(rows, gone), days, _ids(gone, stored=False))
    return counts


def _delete_links(spark: SparkSession, path: str, gone: DataFrame) -> int:
    links, by, old = read_links(spark, path), (), commits.data_files(spark, path)
    if any(f.startswith("part=") for f in old):
        touched = [r.part for r in _parted(gone).select("part").distinct().collect()]  # LINK_PARTS at most
        links = spark.read.parquet(path).where(F.col("part").isin(touched))
        by, old = ("part",), [f for f in old if int(f.split("/")[0].removeprefix("part=")) in touched]
    deleted = links.join(gone, "story_id", "left_semi").count()
    if deleted:
        commits.change(spark, path, delete_by_key(links, gone), by, replaces=old)
    return deleted
