"""The ingest job as a stream: each batch is a load of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators import clean
from newsflow.plans.ingest import filter_min_score, run_ingest, tag_articles
from newsflow.rules import Rules
from newsflow.streaming.streams import each_batch


def ingest_stream(feed: DataFrame, rules: Rules) -> DataFrame:
    """Valid and tagged articles of a feed stream, repeats included."""
    articles = clean.truncate_headline(clean.normalize_articles(feed), rules.max_headline_length)
    articles = clean.filter_sources(articles, rules.excluded_sources)
    tagged = filter_min_score(tag_articles(articles, rules), rules)
    return tagged.withColumn("published_date", F.to_date("published_at"))


def load_stream(
    feed: DataFrame, rules: Rules, path: str, checkpoint: str, name: str = "stream", as_of: Column | None = None, every: str | None = None, **settings
) -> StreamingQuery:
    """:func:`newsflow.plans.ingest.run_ingest` for each batch of a feed stream, with bodies, languages and the run log.

    A batch is a load named by its number: run again, it does nothing if it is stored, and is finished or undone
    first if it broke off. Near-duplicates are judged by what the store holds when a batch arrives; without them
    (``similarity=None``) the store holds the same stories as after one load of all, in whatever order and batches
    they come. ``as_of`` is the time of each load, by default that of the batch.
    """

    def put(batch: DataFrame, number: int) -> None:
        run_ingest(batch, rules, path, F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of, load=f"{name}-{number:08d}", **settings)

    return each_batch(feed, put, checkpoint, every)
