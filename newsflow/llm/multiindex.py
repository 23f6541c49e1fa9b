"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: one more component evens out the norms, so that
the largest inner product is the smallest angle, and a rotation learned on a sample (PCA, then iterative
quantisation) turns signs into bits. Each byte of the codes is indexed. If two codes differ in
at most r bits, some byte differs in at most a share of them (the pigeonhole
principle), so probing the buckets near each byte of a query retrieves every
code within r. What lies within r is ranked by the vectors themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.llm.tables import keep, shuffles_dropped

BITS = 64
SAMPLE = 4_096  # vectors that the rotation is learned on
PROBES = 256  # of them, whose true neighbours among all rows set the radius
REACH = 0.97  # share of those neighbours within the radius
SHARD_ROWS, LEAST_ROWS = 131_072, 4_096  # rows of a shard: at most, and at least if there are tasks to spare
_FOUND = "query_id long, vec_id long, score double"
_COUNTS = np.bitwise_count(np.arange(256, dtype=np.uint8))
_FLIPS = [np.flatnonzero(_COUNTS <= r).astype(np.uint8) for r in range(9)]


def usable(df: DataFrame) -> DataFrame:
    """``vec_id, embedding``: rows with an id and a vector that is not null, empty or zero and holds no null or non-finite component."""
    x = F.col("embedding")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return df.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, reach: float = REACH) -> DataFrame:
    """The ``k`` nearest rows found for each query by inner product, about ``reach`` of the true ones.

    Both tables are as of :func:`usable`. Candidates are the rows of the query's length, but
    those of its own id; ties go to the smaller ``vec_id``. A query that finds fewer than ``k``
    within the radius is asked again with a wider one, at last with that of all codes. Returns
    ``query_id, rank, vec_id, score``. Repeated rows count once; rows that repeat an
    id with another vector are candidates of their own, and queries that do so are ranked
    together. Products must stay within the range of double. Empty tables give an empty table.
    """
    spark = rows.sparkSession
    found = spark.createDataFrame([], _FOUND)
    with shuffles_dropped(spark):
        queries = keep(queries.distinct(), "queries")
        # one row for each length of a vector, few in any table
        for d in sorted(r.d for r in queries.select(F.size("embedding").alias("d")).distinct().collect()):
            same = F.size("embedding") == d
            found = found.union(_search(rows.where(same), queries.where(same), d, k, reach))
        return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, queries: DataFrame, d: int, k: int, reach: float) -> DataFrame:
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    size = rows.agg(F.count("*").alias("n"), F.max(squares).alias("square")).first()
    if not size.n:
        return rows.sparkSession.createDataFrame([], _FOUND)
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(math.ceil(size.n / SHARD_ROWS), min(tasks, math.ceil(size.n / LEAST_ROWS)))
    ids, sample = _sample(rows, size.n)
    code = Code.learn(sample, math.sqrt(size.square))
    radius = _radius(rows, code, ids[:PROBES], sample[:PROBES], k, reach)
    waves, asked = [], queries
    while True:
        wave = keep(_best(_wave(rows, asked, d, shards, code, radius, k), k), "found")
        if radius < code.bits:
            full = wave.groupBy("query_id").count().where(F.col("count") >= k)
            short = asked.join(full, asked.vec_id == full.query_id, "left_anti")
            waves.append(wave.join(full.select("query_id"), "query_id", "left_semi"))
            if not short.isEmpty():
                asked, radius = short, min(code.bits, radius + max(1, code.bits // 4))
                continue
            break
        waves.append(wave)
        break
    out = waves[0]
    for wave in waves[1:]:
        out = out.union(wave)
    return out.select("query_id", "vec_id", "score")


# -- codes -----------------------------------------------------------------------------------


class Code:
    """Binary codes of vectors, eight bits to a byte."""

    def __init__(self, longest: float, mean: np.ndarray, turn: np.ndarray):
        self.longest, self.mean, self.turn, self.bits = longest, mean, turn, turn.shape[1]

    @staticmethod
    def learn(sample: np.ndarray, longest: float) -> Code:
        """Principal directions, turned so that the sample lies close to the corners of a cube."""
        code = Code(longest, np.zeros(sample.shape[1] + 1), np.eye(sample.shape[1] + 1))
        points = code._even(sample)
        mean = points.mean(axis=0)
        bits = min(BITS, sample.shape[1])
        directions = np.linalg.svd((points - mean).T @ (points - mean))[0][:, :bits]
        flat = (points - mean) @ directions
        turn = np.linalg.qr(np.random.RandomState(13).standard_normal((bits, bits)))[0]
        for _ in range(40):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        return Code(longest, mean, directions @ turn)

    def _even(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of one length: as much of the longest one as each lacks goes into a further component."""
        vectors = vectors / self.longest
        return np.concatenate([vectors, np.sqrt(np.maximum(0, 1 - (vectors**2).sum(axis=1)))[:, None]], axis=1)

    def _bytes(self, even: np.ndarray) -> np.ndarray:
        return np.packbits((even - self.mean) @ self.turn > 0, axis=1)

    def of_rows(self, vectors: np.ndarray) -> np.ndarray:
        return self._bytes(self._even(vectors))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        """A query's length does not matter to its order of rows."""
        unit = vectors / np.abs(vectors).max(axis=1)[:, None]
        unit = unit / np.sqrt((unit**2).sum(axis=1))[:, None]
        return self._bytes(np.concatenate([unit, np.zeros((len(unit), 1))], axis=1))


def _distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=-1, dtype=np.int64)


def _sample(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of about ``SAMPLE`` rows, the first in the order of a hash."""
    order = F.xxhash64("vec_id", F.lit(17))
    share = min(1.0, 1.3 * SAMPLE / n)
    picked = rows.where(order <= int((2 * share - 1) * (2**63 - 1024))) if share < 1 else rows
    picked = picked.orderBy(order, F.xxhash64("embedding")).limit(SAMPLE).collect()
    return np.array([r.vec_id for r in picked]), np.array([r.embedding for r in picked], dtype=float)


def _radius(rows: DataFrame, code: Code, ids: np.ndarray, probes: np.ndarray, k: int, reach: float) -> int:
    """The Hamming radius that holds ``reach`` of the true ``k`` nearest rows of the probes."""
    codes, d = code.of_queries(probes), probes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, far = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
        for batch in batches:
            here, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), d)
            for lo in range(0, len(here), 4096):
                part = vectors[lo : lo + 4096]
                score = probes @ part.T
                score[ids[:, None] == here[None, lo : lo + 4096]] = -np.inf
                apart = _distances(code.of_rows(part)[None, :, :], codes[:, None, :])
                both = np.concatenate([scores, score], axis=1)
                top = np.argpartition(both, -k, axis=1)[:, -k:]
                far = np.take_along_axis(np.concatenate([far, apart], axis=1), top, 1)
                scores = np.take_along_axis(both, top, 1)
        probe, at = np.nonzero(scores > -np.inf)
        yield pa.record_batch({"probe": probe, "score": scores[probe, at], "far": far[probe, at]})

    best = Window.partitionBy("probe").orderBy(F.desc("score"))
    found = rows.mapInArrow(run, "probe long, score double, far long").withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)
    counts = sorted((r.far, r["count"]) for r in found.groupBy("far").count().collect())  # one row per distance
    left = reach * sum(n for _, n in counts)
    for far, n in counts:
        left -= n
        if left <= 0:
            return int(far)
    return code.bits


# -- search ----------------------------------------------------------------------------------


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d).astype(float)


def _wave(rows: DataFrame, queries: DataFrame, d: int, shards: int, code: Code, radius: int, k: int) -> DataFrame:
    """The best of each shard. A task indexes the rows of its shard once, then queries stream past them."""
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    dealt = rows.select(shard.alias("shard"), F.lit(False).alias("asks"), "vec_id", "embedding").union(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), F.lit(True), "vec_id", "embedding")
    )
    laid = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index, at = [], None, None
        for batch in batches:
            shard, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(shard) != 0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
                if lo == hi:
                    continue
                if shard[lo] != at:
                    held, index, at = [], None, shard[lo]
                ids, vectors = batch.column(2).to_numpy()[lo:hi], _matrix(batch.column(3).slice(lo, hi - lo), d)
                if not asks[lo]:
                    held.append((ids, vectors))
                elif held:
                    if index is None:
                        index = _Index(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), code)
                    yield index.search(ids, vectors, radius, k)

    return laid.mapInArrow(run, _FOUND)


class _Index:
    """The rows of a shard in the order of each byte of their codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, code: Code):
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():
            order = np.lexsort([*vectors.T[::-1], ids])
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)  # repeated rows count once
        new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
        self.ids, self.vectors, self.code = ids[new], vectors[new], code
        self.codes = code.of_rows(self.vectors)
        self.longest = math.sqrt((self.vectors**2).sum(axis=1).max())
        self.places, self.starts = [], []
        for byte in self.codes.T:
            self.places.append(np.argsort(byte, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(byte, minlength=256))]).tolist())

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes within ``radius`` of ``code``.

        With m bytes and r = a * m + b, one of the first b + 1 bytes differs in at most a bits or
        one of the others in at most a - 1.
        """
        near = np.zeros(len(self.ids), bool)
        share, more = divmod(radius, len(code))
        for i, byte in enumerate(code):
            reach = min(8, share if i <= more else share - 1)
            if reach < 0:
                continue
            places, starts = self.places[i], self.starts[i]
            for bucket in (byte ^ _FLIPS[reach]).tolist():
                near[places[starts[bucket] : starts[bucket + 1]]] = True
        found = np.flatnonzero(near)
        return found[_distances(self.codes[found], code) <= radius]

    def search(self, own: np.ndarray, vectors: np.ndarray, radius: int, k: int) -> pa.RecordBatch:
        query, row, score = [], [], []
        codes = self.code.of_queries(vectors)
        for i, asked in enumerate(vectors):
            found = self.within(codes[i], radius)
            found = found[self.ids[found] != own[i]]
            if len(found) > k:
                rough = self.vectors[found] @ asked
                slack = 1e-12 * self.longest * math.sqrt((asked**2).sum())
                found = found[rough >= np.partition(rough, -k)[-k] - slack]
            exact = (self.vectors[found] * asked).sum(axis=1)  # equal rows have equal sums here
            best = np.lexsort([self.ids[found], -exact])[:k]
            query.append(np.full(len(best), own[i]))
            row.append(self.ids[found[best]])
            score.append(exact[best])
        return pa.record_batch({"query_id": np.concatenate(query), "vec_id": np.concatenate(row), "score": np.concatenate(score)})
