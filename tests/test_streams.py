"""Streams give what the batch gives, late rows included."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newsflow.plans import ingest
from newsflow.plans.stream_ingest import ingest_stream, load_stream
from newsflow.rules import Rules
from newsflow.session import scratch_path
from newsflow.sources import commits, runlog, store
from newsflow.streaming import streams

T0 = datetime(2024, 1, 1)
SCHEMA = "story_id string, ts timestamp_ntz"


def arrive(spark, path, *rows):
    """Write one file of rows: (id, minutes after T0)."""
    data = [(i, T0 + timedelta(minutes=m)) for i, m in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return streams.with_event_time(spark.readStream.schema(SCHEMA).parquet(path), "ts")


def test_polls_drop_only_rows_later_than_the_watermark(spark):
    path = scratch_path(spark, "late-test")
    source, table, checkpoint = (f"{path}/{p}" for p in ("source", "table", "checkpoint"))

    def poll():
        counted = streams.hourly_counts(stream(spark, source), "ts").select(F.hour("window.start").alias("h"), "n")
        streams.poll(counted, table, checkpoint)

    arrive(spark, source, ("a", 10), ("b", 70), ("c", 230))  # watermark 02:50: hours 0 and 1 close
    poll()
    arrive(spark, source, ("too late", 20), ("in time", 125), ("d", 600))  # closes hours 2 and 3
    poll()
    got = {r.h: r.n for r in spark.read.parquet(table).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1}


def test_a_poll_reads_only_what_is_new(spark):
    path = scratch_path(spark, "dedup-test")
    source, table, checkpoint = (f"{path}/{p}" for p in ("source", "table", "checkpoint"))
    arrive(spark, source, ("a", 0), ("b", 1), ("a", 2))
    streams.store_new(stream(spark, source), table, checkpoint, "story_id")
    arrive(spark, source, ("b", 3), ("c", 4))
    streams.store_new(stream(spark, source), table, checkpoint, "story_id")
    assert sorted(r.story_id for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def test_many_copies_of_one_story(spark):
    path = scratch_path(spark, "hot-test")
    arrive(spark, path, *[("hot", m % 50) for m in range(2000)], *[(str(i), i % 50) for i in range(1000)])
    kept = streams.loaded_new(stream(spark, path), "hot", "story_id")
    assert (kept.count(), kept.where("story_id = 'hot'").count()) == (1001, 1)


def test_exclude_stored(spark):
    path = scratch_path(spark, "stored-test")
    arrive(spark, path, ("a", 0), ("b", 1), ("c", 2))
    stored = scratch_path(spark, "stored-ids")
    streams.put_new(spark.createDataFrame([("b",), ("b",)], "story_id string"), stored, "story_id")
    kept = streams.loaded_new(stream(spark, path), "stored", "story_id", stored=stored)
    assert sorted(r.story_id for r in kept.collect()) == ["a", "c"]


def test_a_table_without_an_index_gets_one(spark):
    path = scratch_path(spark, "plain-test")
    arrive(spark, f"{path}/table", ("a", 0))
    arrive(spark, f"{path}/source", ("a", 1), ("b", 1))
    streams.store_new(stream(spark, f"{path}/source"), f"{path}/table", f"{path}/checkpoint", "story_id")
    assert sorted(r.story_id for r in spark.read.parquet(f"{path}/table").collect()) == ["a", "b"]


def test_an_empty_stream_leaves_an_empty_table(spark):
    path = scratch_path(spark, "empty-test")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert streams.loaded_new(stream(spark, path), "empty", "story_id").count() == 0
    counted = streams.hourly_counts(stream(spark, path), "ts").select(F.col("window.start").alias("h"), "n")
    assert streams.latest_counts(counted, "empty").count() == 0


def test_counts_are_compacted_without_loss(spark, monkeypatch):
    monkeypatch.setattr(streams, "COMPACT_EVERY", 2)
    path = scratch_path(spark, "compact-test")
    for hour in range(5):
        arrive(spark, f"{path}/source", ("a", 60 * hour), ("b", 60 * hour + 30), ("c", 0))
        counted = streams.hourly_counts(stream(spark, f"{path}/source"), "ts", "story_id").select(F.hour("window.start").alias("h"), "story_id", "n")
        streams.upsert_counts(counted, f"{path}/table", f"{path}/checkpoint")
    got = {(r.h, r.story_id): r.n for r in streams.read_counts(spark, f"{path}/table", counted.schema).collect()}
    assert got[(4, "a")] == 1 and got[(0, "c")] == 3 and len(got) == 11  # c: too late from the fourth poll on


def test_sliding_window_counts(spark):
    path = scratch_path(spark, "slide-test")
    arrive(spark, path, ("a", 62), ("b", 64), ("c", 66), ("end", 1000))
    got = streams.loaded(streams.sliding_counts(stream(spark, path), "ts").select("window.start", "n"), "slide")
    counts = {r.start: r.n for r in got.collect()}
    assert counts[T0 + timedelta(minutes=60)] == 3
    assert counts[T0 + timedelta(minutes=65)] == 1
    assert counts[T0 + timedelta(minutes=5)] == 2
    assert sum(counts.values()) == 36


def test_ingest_stream(spark):
    path = scratch_path(spark, "ingest-test")
    rows = [
        ("1", "Copper strike", "2024-01-01T10:00:00Z", "NS:RTRS"),
        ("1", "Copper strike", "2024-01-01T10:00:00Z", "NS:RTRS"),
        ("2", " ", "2024-01-01T10:00:00Z", "NS:RTRS"),
        ("3", "zinc price", "2024-01-02T10:00:00Z", "NS:SPAM"),
        ("4", "zinc price", "2024-01-02T10:00:00Z", "NS:ABC"),
    ]
    schema = "storyId string, text string, versionCreated string, sourceCode string"
    spark.createDataFrame(rows, schema).write.parquet(path)
    feed = spark.readStream.schema(schema).parquet(path)
    stored = streams.loaded_new(ingest_stream(feed, Rules()), "ingest", "story_id")
    got = {r.story_id: (r.source, r.categories, r.priority_score, str(r.published_date)) for r in stored.collect()}
    assert got == {
        "1": ("Reuters", ["COPPER"], 10, "2024-01-01"),
        "4": ("NS:ABC", ["ZINC"], 5, "2024-01-02"),
    }


def test_what_is_stored_does_not_depend_on_the_batches(spark):
    """Days that arrive newest first, one file a batch, with repeats of other days."""
    path = scratch_path(spark, "batches")
    for day in (5, 3, 4, 1, 2):
        arrive(spark, f"{path}/source", (f"s{day}", 1440 * day), (f"s{day % 3}", 1440 * (day % 3)))
    schema = spark.read.parquet(f"{path}/source").schema
    for files in (1, 100):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path}/source")
        assert sorted(r.story_id for r in streams.loaded_new(rows, "batches", "story_id").collect()) == ["s0", "s1", "s2", "s3", "s4", "s5"]


def test_continuous_load(spark):
    path = scratch_path(spark, "start-test")
    source, table, checkpoint = (f"{path}/{p}" for p in ("source", "table", "checkpoint"))
    arrive(spark, source, ("a", 0), ("b", 1))
    dated = stream(spark, source).withColumn("day", F.to_date("ts"))
    query = streams.start(dated, table, checkpoint, every="1 second", partition_by=("day",))
    try:
        query.processAllAvailable()
        arrive(spark, source, ("c", 1500))
        query.processAllAvailable()
    finally:
        query.stop()
    assert {(r.story_id, str(r.day)) for r in spark.read.parquet(table).collect()} == {
        ("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-02"),
    }


FEED = "storyId string, text string, versionCreated string, sourceCode string"


def _files(spark, path):
    """Six files of a feed, with repeats between them."""
    words = ["copper strike", "zinc price", "tin demand", "nothing", "nickel supply"]
    for n in range(6):
        rows = [(str(i), f"{words[i % 5]} {i}", f"2024-01-{1 + i % 9:02d}T10:00:00Z", "NS:ABC") for i in range(n * 10, n * 10 + 14)]
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(path)


def _content(spark, path):
    columns = ("story_id", "headline", "body_text", "source", "categories", "priority_score", "published_at")
    return sorted(tuple(map(str, r)) for r in store.read_articles(spark, path).select(*columns).collect())


def test_a_stream_equals_the_batch_load(spark):
    path = scratch_path(spark, "stream-load")
    _files(spark, f"{path}/feed")
    rules, as_of = Rules(minimum_score=5, similarity=None), F.lit("2024-02-01").cast("timestamp_ntz")
    bodies = spark.createDataFrame([("11", "lme price")], "story_id string, body_text string")
    ingest.run_ingest(spark.read.schema(FEED).parquet(f"{path}/feed"), rules, f"{path}/batch", as_of, bodies=bodies)
    want = _content(spark, f"{path}/batch")
    assert want and any(r[2] == "lme price" for r in want)
    for files in (1, 100):
        feed = spark.readStream.schema(FEED).option("maxFilesPerTrigger", files).parquet(f"{path}/feed")
        load_stream(feed, rules, f"{path}/{files}", f"{path}/checkpoint{files}", as_of=as_of, bodies=bodies)
        assert _content(spark, f"{path}/{files}") == want
        log = runlog.read_log(spark, f"{path}/{files}").collect()
        assert {r.status for r in log} == {"completed"} and sum(r.articles_inserted for r in log) == len(want)


def test_a_batch_that_breaks_off_is_finished_or_undone(spark, monkeypatch):
    """The job stops after one of the staged files is moved, then before its stage is marked; each time the next run makes it whole."""
    path = scratch_path(spark, "broken")
    _files(spark, f"{path}/feed")
    rules, as_of = Rules(minimum_score=5, similarity=None), F.lit("2024-02-01").cast("timestamp_ntz")
    batch = spark.read.schema(FEED).parquet(f"{path}/feed")
    ingest.run_ingest(batch, rules, f"{path}/whole", as_of)
    want, whole = _content(spark, f"{path}/whole"), commits._move_in

    def half(spark, source, target):
        names = commits.data_files(spark, source)
        with monkeypatch.context() as only:
            only.setattr(commits, "data_files", lambda *_: names[:1])
            whole(spark, source, target)
        raise OSError("stopped")

    for name, broken in (("_move_in", half), ("_touch", lambda *_: (_ for _ in ()).throw(OSError("stopped")))):
        store_path = f"{path}/{name}"
        with monkeypatch.context() as stop:
            stop.setattr(commits, name, broken)
            try:
                ingest.run_ingest(batch, rules, store_path, as_of, load="one")
                raise AssertionError("not stopped")
            except OSError:
                pass
        ingest.run_ingest(batch, rules, store_path, as_of, load="one")
        assert _content(spark, store_path) == want
        assert {r.run_id: r.status for r in runlog.read_log(spark, store_path).collect()}["one"] in ("completed", "failed")
