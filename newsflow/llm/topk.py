"""Exact top-k inner products with a ball tree per shard.

Rows are dealt into shards of bounded size. A task builds the ball tree of its shard once, and queries
stream past it: every query opens the nodes in the order of their upper bounds on the inner product and
stops when the best bound left is below its k-th score. Shards are searched in waves: first one for
each query, then a quarter of the others, then the rest. After each wave the k-th scores found so far are
shared by all shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.llm.tables import forget, keep, shuffles_dropped

SHARD_ROWS, LEAST_ROWS, LEAF_ROWS = 65_536, 4_096, 512  # rows of a shard: at most, and at least if there are tasks to spare
_NONE = np.iinfo(np.int64).min  # the score of an empty place
_FOUND = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of each component of ``embedding``.

    Rows without id, with a null vector, or with a null or non-finite
    component are left out; repeated rows count once.
    """
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    vector = F.transform(x, lambda v: F.floor(v * float(scale)).cast("long"))
    rows = df.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).distinct()


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows with the highest inner product for each query.

    Both tables have ``vec_id long`` and ``vector array<long>``. Candidates are all
    rows of the same length but those with the query's own id; fewer than ``k`` are
    all returned. Ties go to the smaller ``vec_id``. Returns ``query_id, rank,
    vec_id, score``. Rows that repeat an id with another vector are candidates of
    their own; queries that do so are ranked together. Scores must fit 63 bits. Empty tables
    give an empty table.
    """
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        rows, queries = keep(rows, "vectors"), keep(queries, "queries")
        n, tasks = rows.count(), spark.sparkContext.defaultParallelism
        shards = max(1, math.ceil(n / SHARD_ROWS), min(tasks, math.ceil(n / LEAST_ROWS)))
        home = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int")
        found, floor = None, None
        for low, high in _waves(shards):
            asked = queries.withColumn("floor", F.lit(None).cast("long")) if floor is None else queries.join(floor, "vec_id", "left")
            ahead = F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
            asked = asked.select("vec_id", "vector", "floor", home.alias("home"), ahead.alias("ahead"))
            asked = asked.withColumn("shard", F.pmod(F.col("home") + F.col("ahead"), F.lit(shards)).cast("int"))
            wave = keep(_best(_search(rows, asked, shards, k), k), "found")
            if found is None:
                found = wave
            else:
                before, found = found, keep(_best(found.union(wave), k), "found")
                forget(before, wave)
            floor = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    return found


def _waves(shards: int) -> list[tuple[int, int]]:
    """How far from a query's own shard those of each wave lie."""
    cuts = sorted({0, 1, 1 + (shards - 1) // 4, shards})
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _best(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, asked: DataFrame, shards: int, k: int) -> DataFrame:
    """Rows are dealt once, whatever the number of queries; in each shard they come before the queries."""
    shard, none = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"), F.lit(None).cast("long")
    dealt = rows.select(shard.alias("shard"), F.lit(False).alias("asks"), "vec_id", "vector", none.alias("floor")).union(
        asked.select("shard", F.lit(True), "vec_id", "vector", "floor")
    )
    laid = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "asks")
    return laid.mapInArrow(_search_shards(k), _FOUND)


def _vectors(table: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the places of the rows and their vectors as one matrix."""
    column = table.column("vector")
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
    sizes = np.diff(offsets)
    out = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        out[size] = at, flat[offsets[at][:, None] + np.arange(size)]
    return out


class _BallTree:
    """Balls around halves of halves of the rows; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        self.levels = max(0, math.ceil(math.log2(max(1, n / LEAF_ROWS))))
        count = (1 << self.levels + 1) - 1
        self.first_leaf = (1 << self.levels) - 1
        self.centre, self.radius = np.zeros((count, vectors.shape[1])), np.full(count, -1.0)
        self.members = [np.zeros(0, np.int64)] * count
        parts = {0: np.arange(n)}
        for node in range(count):
            own = parts.pop(node)
            if len(own):
                points = vectors[own]
                self.centre[node] = points.mean(axis=0)
                self.radius[node] = math.sqrt(((points - self.centre[node]) ** 2).sum(axis=1).max())
            if node < self.first_leaf:
                half = len(own) // 2
                if half and points.shape[1]:
                    spread = np.ptp(points, axis=0)
                    own = own[np.argpartition(points[:, int(spread.argmax())], half)]
                parts[2 * node + 1], parts[2 * node + 2] = own[:half], own[half:]
            else:
                self.members[node] = own


def _search_shards(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, trees, at = {}, {}, None
        for batch in batches:
            shard, asks = batch.column("shard").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(shard) != 0) | (asks[1:] != asks[:-1])) + 1).tolist(), len(shard)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if shard[lo] != at:
                    held, trees, at = {}, {}, shard[lo]
                part = batch.slice(lo, hi - lo)
                ids = part.column("vec_id").to_numpy()
                for size, (which, vectors) in _vectors(part).items():
                    if not asks[lo]:
                        held.setdefault(size, []).append((ids[which], vectors))
                    elif size in held:
                        if size not in trees:
                            trees[size] = _Shard(*(np.concatenate([h[i] for h in held[size]]) for i in (0, 1)))
                        floors = part.column("floor").to_pandas().to_numpy(dtype=float, na_value=-np.inf)[which]
                        for first in range(0, len(which), 1024):
                            some = slice(first, first + 1024)
                            found = _search_tree(trees[size], ids[which][some], vectors[some], floors[some], k)
                            yield pa.record_batch({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    return run


class _Shard:
    """The rows of a shard by id, and their ball tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.points = self.vectors.astype(float)
        self.most = float(np.abs(self.vectors).max(initial=0)) * vectors.shape[1]
        self.tree = _BallTree(self.points)


def _search_tree(shard: _Shard, own, queries, floors, k):
    """Query ids, row ids and scores of the best ``k`` rows of a shard at or above each floor."""
    ids, tree = shard.ids, shard.tree
    n, m = len(ids), len(own)
    limit = shard.most * float(np.abs(queries).max(initial=0))
    exact = limit < 2**52
    points, asks = (shard.points, queries.astype(float)) if exact else (shard.vectors, queries)
    packs = limit < 2**42 and n < 1 << 20
    real = queries.astype(float)
    bound = real @ tree.centre.T + np.sqrt((real**2).sum(axis=1))[:, None] * tree.radius
    bound = np.floor(bound + 1e-6 + 1e-9 * np.abs(bound) + (0 if exact else limit * 1e-9))  # scores are whole numbers
    bound[:, tree.radius < 0] = -np.inf
    open_bound = np.full(bound.shape, -np.inf)
    open_bound[:, 0] = bound[:, 0]
    score = np.full((m, k), _NONE, np.int64)
    place = np.full((m, k), n, np.int64)
    kth = floors.copy()
    live = np.arange(m)
    while len(live):
        node = open_bound[live].argmax(axis=1)
        best = open_bound[live, node]
        going = (best >= kth[live]) & (best > -np.inf)
        live, node = live[going], node[going]
        open_bound[live, node] = -np.inf
        inner = node < tree.first_leaf
        for child in (1, 2):
            at = 2 * node[inner] + child
            open_bound[live[inner], at] = bound[live[inner], at]
        order = np.argsort(node[~inner], kind="stable")
        leaves, who = node[~inner][order], live[~inner][order]
        for part in np.split(np.arange(len(who)), np.flatnonzero(np.diff(leaves)) + 1) if len(who) else []:
            q, members = who[part], np.sort(tree.members[int(leaves[part[0]])])
            scores = (asks[q] @ points[members].T).astype(np.int64)
            scores[own[q][:, None] == ids[members][None, :]] = _NONE
            better = scores.max(axis=1) >= kth[q]  # the others find nothing here
            q, scores = q[better], scores[better]
            if not len(q):
                continue
            both = np.concatenate([score[q], scores], axis=1)
            places = np.concatenate([place[q], np.broadcast_to(members, scores.shape)], axis=1)
            if packs:  # one whole number orders by score, then by smaller place
                key = np.where(both == _NONE, _NONE, (both << 20) | ((1 << 20) - 1 - places))
                top = np.argpartition(key, -k, axis=1)[:, -k:]
            else:
                by_place = np.argsort(places, axis=1, kind="stable")
                both, places = np.take_along_axis(both, by_place, 1), np.take_along_axis(places, by_place, 1)
                top = np.argsort(~both, axis=1, kind="stable")[:, :k]  # ~x falls as x grows, without overflow
            score[q], place[q] = np.take_along_axis(both, top, 1), np.take_along_axis(places, top, 1)
            last = score[q].min(axis=1)
            kth[q] = np.where(last > _NONE, np.maximum(floors[q], last), kth[q])
    row, col = np.nonzero((score > _NONE) & (score >= floors[:, None]))
    return np.stack([own[row], ids[place[row, col]], score[row, col]])
