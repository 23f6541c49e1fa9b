"""Work along one global order, with keys and times that many rows share."""

import random

from pyspark.sql import functions as F

from newsflow.operators import dedup, ordered, paging


def skewed(n=3000, seed=1):
    """Rows of which a third share one group and one time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(("hot" if hot else f"g{rng.randrange(40)}", 500 if hot else rng.randrange(1000), f"{i:05d}", rng.randrange(10)))
    rng.shuffle(rows)
    return rows


SCHEMA = "g string, at long, id string, x long"


def test_number_rows(spark):
    rows = skewed()
    got = ordered.number_rows(spark.createDataFrame(rows, SCHEMA), F.desc("at"), F.asc("id"), name="n").collect()
    expected = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [r[2] for r in expected]
    assert sorted(r.n for r in got) == list(range(1, len(rows) + 1))


def test_running_totals(spark):
    rows = skewed()
    got = ordered.running_totals(spark.createDataFrame(rows, SCHEMA), "at", "id", totals={"s": "x"}).collect()
    total, expected = 0, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        total += r[3]
        expected[r[2]] = total
    assert {r.id: r.s for r in got} == expected


def test_last_before(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, SCHEMA)
    for among, flag in ((None, lambda r: True), (F.col("x") > 6, lambda r: r[3] > 6)):
        got = ordered.last_before(df, ["g"], ["at", "id"], {"before": "id"}, among).collect()
        last, expected = {}, {}
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            expected[r[2]] = last.get(r[0])
            if flag(r):
                last[r[0]] = r[2]
        assert {r.id: r.before for r in got} == expected


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.createDataFrame(skewed(30000), SCHEMA)
    laid = ordered.in_order(df, "g", "at", "id").where("g = 'hot'")
    assert laid.select(ordered.PART).distinct().count() >= 2


def test_window_candidates(spark):
    rng = random.Random(3)
    rows = [(f"{i:03d}", rng.choice([0, 3600, 7200, 86400, 86401]) + rng.randrange(0, 200000, 3600)) for i in range(300)]
    df = spark.createDataFrame(rows, "story_id string, s long").select(
        "story_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("published_at")
    )
    got = {r.story_id: (r.n_candidates, r.nearest_gap_s) for r in dedup.window_candidates(df, 24).collect()}
    for story, at in rows:
        earlier = [at - a for s, a in rows if (a, s) < (at, story) and a >= at - 86400]
        assert got[story] == (len(earlier), min(earlier) if earlier else None)


def test_pages_lose_no_ties(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, SCHEMA)
    paged = paging.assign_pages(df, 100, time="at", ties=("id",))
    bounds = {r.page: r for r in paging.page_bounds(paged, "at").collect()}
    assert sum(b.n_rows for b in bounds.values()) == len(rows)
    assert all(b.n_rows == 100 for b in bounds.values())
    assert all(bounds[p].oldest >= bounds[p + 1].newest for p in range(1, len(bounds)))
    limited = paging.assign_pages(df, 100, 2, time="at", ties=("id",))
    assert limited.count() == 200


def test_page_counts(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "a"), (2, "c"), (3, "c"), (3, "b"), (4, "d")]
    counts = paging.page_duplicate_counts(spark.createDataFrame(rows, "page long, story_id string"))
    assert {r.page: (r.n_rows, r.new_rows, r.duplicates) for r in counts.collect()} == {
        1: (2, 2, 0), 2: (3, 1, 2), 3: (2, 0, 2), 4: (1, 1, 0),
    }
    totals = paging.page_running_totals(counts, "n_rows", "new_rows")
    assert {r.page: (r.total_n_rows, r.total_new_rows) for r in totals.collect()} == {1: (2, 2), 2: (5, 3), 3: (7, 3), 4: (8, 4)}


def test_running_totals_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(paging, "_BLOCK", 7)
    counts = spark.range(1, 51).select(F.col("id").alias("page"), F.col("id").alias("n"))
    got = {r.page: r.total_n for r in paging.page_running_totals(counts, "n").collect()}
    assert got == {p: p * (p + 1) // 2 for p in range(1, 51)}
