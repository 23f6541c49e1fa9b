"""Whitening of embeddings along their largest principal components.

The covariance of the distinct vectors is summed in whole numbers, part by part. Its
largest eigenpairs come from FEAST contour integration: inertia counts bracket
an interval with the wanted eigenvalues, tasks solve the shifted systems at the
nodes of a circle around it, their weighted sum projects a block of vectors onto the
interval's eigenvectors, and Rayleigh-Ritz extracts the pairs. The number found
must equal the inertia count. A last pass projects the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.tables import keep, shuffles_dropped

COMPONENTS = 4
NODES = 8  # of the quadrature, on the upper half circle
MORE = 8  # eigenvalues that an interval may hold beyond those wanted
_EXACT = 1 << 20  # deviations from the mean below this are multiplied exactly, block by block
_BLOCK = 8_192
_MOST = (1 << 63) - 1
_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``x``: floor(scale * c) of each entry c of ``embedding``, as double.

    Rows with a null vector, or with a null or non-finite entry, are left out, and those with an
    entry beyond the range of long once scaled.
    """
    c = F.col("embedding").cast("array<double>")
    good = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * float(scale) < 2.0**63))
    x = F.transform(c, lambda v: F.floor(v * float(scale)).cast("long"))
    return df.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each row of ``(vec_id, x array<long>)`` along up to ``components`` principal components.

    Fitted on the distinct vectors, n in all with sums S. Returns ``vec_id``,
    ``component`` (from 1, by falling eigenvalue e), ``n``, ``deviation`` (sum of (n * x - S)^2, null
    beyond the range of long), ``whitened`` (x - S / n on the unit eigenvector, over sqrt(e)),
    ``explained`` (e / trace) and ``identity_error`` (largest entry of the whitened
    vectors' covariance minus the identity). Components without variance are left out: one
    vector, or equal ones, give no rows. Rows may repeat, also their ids. Vectors of
    each length are a table of their own; empty ones have no component. Only
    d x d sums and d x 12 blocks pass through the driver, d being the length.
    """
    spark = rows.sparkSession
    out = spark.createDataFrame([], _SCHEMA)
    with shuffles_dropped(spark):
        rows = keep(rows, "vectors")
        fit = keep(rows.select("x").distinct(), "fit")
        for length in sorted(r.d for r in fit.select(F.size("x").alias("d")).distinct().collect() if r.d > 0):
            same = F.size("x") == length
            model = _fit(fit.where(same), length, components)
            if model is not None:
                out = out.union(rows.where(same).mapInArrow(_projected(*model), _SCHEMA))
    return out


# -- sums ------------------------------------------------------------------------------------


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, [0] * d, None, None
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if len(x):
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
                wide = max(abs(int(low.min())), abs(int(high.max()))) * len(x) > _MOST
                part = x.astype(object).sum(axis=0) if wide else x.sum(axis=0)
                total = [a + int(b) for a, b in zip(total, part, strict=True)]
                n += len(x)
        if n:
            sums = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            yield pa.record_batch({"at": np.arange(d, dtype=np.int32), "n": np.full(d, n), "total": sums, "low": low, "high": high})

    return run


def _products(d: int, middle: np.ndarray, exact: bool):
    """Sums of (x - middle)(x - middle)^T over a partition: whole numbers if ``exact``."""

    def rows(total: np.ndarray) -> pa.RecordBatch:
        i, j = np.triu_indices(d)
        values = total[i, j]
        column = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)) if exact else pa.array(values)
        return pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "total": column})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = np.zeros((d, d), np.int64 if exact else float), 0
        for batch in batches:
            y = (_matrix(batch.column(0), d) - middle).astype(float)
            for lo in range(0, len(y), _BLOCK):  # at most 2^13 products below 2^40: exact in a double
                part = y[lo : lo + _BLOCK]
                part = part.T @ part
                total += part.astype(np.int64) if exact else part
                blocks += 1
                if exact and blocks == 1_000:  # before 63 bits run out
                    yield rows(total)
                    total, blocks = np.zeros_like(total), 0
        if blocks:
            yield rows(total)

    return run


def _fit(fit: DataFrame, d: int, components: int):
    """Number of vectors, sums, eigenvalues, eigenvectors, trace and identity error; None without variance."""
    sums = fit.mapInArrow(_sums(d), "at int, n long, total decimal(38,0), low long, high long")
    sums = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    sums = sorted(sums.collect())  # one row per dimension
    n, total = sums[0].n, [int(r.total) for r in sums]
    middle = np.array([round(t / n) for t in total], np.int64)
    widest = max(max(r.high - m, m - r.low) for r, m in zip(sums, middle.tolist(), strict=True))
    exact = widest < _EXACT
    kind = "decimal(38,0)" if exact else "double"
    parts = fit.mapInArrow(_products(d, middle, exact), f"i int, j int, total {kind}")
    pairs = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # d * (d + 1) / 2 rows
    rest = [t - n * int(m) for t, m in zip(total, middle, strict=True)]  # sums of x - middle
    covariance = np.zeros((d, d))
    for r in pairs:
        product = int(r.total) * n - rest[r.i] * rest[r.j] if exact else r.total * n - float(rest[r.i]) * float(rest[r.j])
        covariance[r.i, r.j] = covariance[r.j, r.i] = product / (n * n)
    trace = math.fsum(covariance.diagonal())
    values, vectors = largest_pairs(fit.sparkSession, covariance, components)
    if not len(values):
        return None
    model = n, total, values, vectors, trace
    k = len(values)
    pairs = fit.select(F.lit(0).cast("long").alias("vec_id"), "x").mapInArrow(_whitened_products(*model), "i int, j int, total double, mean double")
    pairs = pairs.groupBy("i", "j").agg(F.sum("total").alias("total"), F.sum("mean").alias("mean")).collect()
    found, mean = np.zeros((k, k)), np.zeros(k)
    for r in pairs:
        found[r.i, r.j] = r.total / n
        mean[r.i] = r.mean / n
    error = float(np.abs(found - np.outer(mean, mean) - np.eye(k)).max())
    return (*model, error)


# -- rows ------------------------------------------------------------------------------------


def _whitened(x: np.ndarray, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list]:
    """Whitened coordinates of the rows, and their exact deviations."""
    # n * x - S lies within n times the range of x
    most = max((n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, total))) if len(x) else 0, 1)
    away = x * n - np.array(total) if most < _MOST else x.astype(object) * n - np.array(total, object)
    if most * most * x.shape[1] < _MOST:
        deviation = (away * away).sum(axis=1).tolist()
    else:
        deviation = [int(v) for v in (away.astype(object) ** 2).sum(axis=1)]
    centred = away.astype(float) / n
    return centred @ vectors / np.sqrt(values), [v if v <= _MOST else None for v in deviation]


def _projected(n, total, values, vectors, trace, error):
    d, k = len(total), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whitened, deviation = _whitened(_matrix(batch.column("x"), d), n, total, values, vectors)
            m = len(whitened)
            at = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id").take(pa.array(at)),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, n),
                    "deviation": pa.array(deviation, pa.int64()).take(pa.array(at)),
                    "whitened": whitened.ravel(),
                    "explained": np.tile(values / trace, m),
                    "identity_error": np.full(m * k, error),
                }
            )

    return run


def _whitened_products(n, total, values, vectors, trace):
    d, k = len(total), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            whitened, _ = _whitened(_matrix(batch.column("x"), d), n, total, values, vectors)
            products += whitened.T @ whitened
            sums += whitened.sum(axis=0)
        i, j = np.indices((k, k)).reshape(2, -1).astype(np.int32)
        yield pa.record_batch({"i": i, "j": j, "total": products.ravel(), "mean": sums[i]})

    return run


# -- eigenpairs ------------------------------------------------------------------------------


def n_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix below ``shift``: the inertia of a pivoted LDL^T factorisation."""
    a = matrix - shift * np.eye(len(matrix))
    limit, count, at, n = (1 + math.sqrt(17)) / 8, 0, 0, len(a)

    def swap(i, j):
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while at < n:
        column = np.abs(a[at + 1 :, at])
        most, own, size = column.max(initial=0), abs(a[at, at]), 1
        if most > 0 and own < limit * most:
            other = at + 1 + int(column.argmax())
            row = np.abs(a[other, at:])
            row[other - at] = 0
            if own * row.max() < limit * most * most:
                if abs(a[other, other]) >= limit * row.max():
                    swap(at, other)
                else:
                    swap(at + 1, other)
                    size = 2
        pivot = a[at : at + size, at : at + size]
        if size == 2:
            count += 1 if pivot[0, 0] * pivot[1, 1] < pivot[0, 1] ** 2 else 2 * int(pivot[0, 0] + pivot[1, 1] < 0)
        else:
            count += int(pivot[0, 0] < 0)
        if size == 2 or pivot[0, 0] != 0:
            below = a[at + size :, at : at + size]
            a[at + size :, at + size :] -= below @ np.linalg.solve(pivot, below.T)
        at += size
    return count


def _interval(above: Callable[[float], int], wanted: int, low: float, high: float) -> tuple[float, float, int]:
    """An interval with at least ``wanted`` eigenvalues, the largest ones, and how many it has.

    ``above(low) >= wanted`` and ``above(high) == 0``. Bisection stops where at most ``MORE`` further ones
    lie above, or where the eigenvalues cannot be told apart; the lower end is the middle of the gap there.
    """
    smallest = (high - low) * 1e-13
    start, held, out = low, above(low), high  # above(start) == held >= wanted, above(out) < wanted
    while held > wanted + MORE and out - start > smallest:
        mid = (start + out) / 2
        count = above(mid)
        if count >= wanted:
            start, held = mid, count
        else:
            out = mid

    def last(count: int, inside: float, outside: float) -> float:
        """The last shift found from ``inside`` towards ``outside`` with so many eigenvalues above it."""
        if above(outside) == count:
            return outside
        for _ in range(12):
            mid = (inside + outside) / 2
            inside, outside = (mid, outside) if above(mid) == count else (inside, mid)
        return inside

    start = (last(held, start, low) + last(held, start, high)) / 2
    return start, last(0, high, start) + smallest, held


def largest_pairs(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, of a positive semidefinite matrix, and unit eigenvectors.

    Eigenvalues that rounding cannot tell from 0 are left out. The entry of each vector that is
    largest in absolute value is positive.
    """
    d = len(matrix)
    trace = math.fsum(matrix.diagonal())
    least = trace * d * 1e-15
    wanted = min(wanted, d - n_below(matrix, least)) if trace > 0 else 0
    if wanted <= 0:
        return np.zeros(0), np.zeros((d, 0))
    low, high, held = _interval(lambda shift: d - n_below(matrix, shift), wanted, least, trace * 1.01)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * math.pi / 2 * (1 - nodes))
    points = (low + high) / 2 + (high - low) / 2 * turn
    size = min(d, held + held // 2 + 4)
    shared = spark.sparkContext.broadcast(matrix)  # d x d
    try:
        while True:
            block = np.random.RandomState(11).standard_normal((d, size))
            best = math.inf
            for _ in range(24):
                solved = _solve(spark, shared, points, weights * turn, block)
                base = np.linalg.qr(solved)[0]
                values, turned = np.linalg.eigh(base.T @ matrix @ base)
                block = base @ turned
                inside = (values > low) & (values < high)
                far = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0)
                if inside.sum() == held and (far <= trace * 1e-16 or (far <= trace * 1e-12 and far >= best / 2)):
                    order = np.flatnonzero(inside)[::-1][:wanted]
                    found = block[:, order]
                    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(wanted)])
                    return values[order], found * signs
                best = min(best, far)
            if size == d:
                raise ArithmeticError(f"{held} eigenvalues counted in the interval, {int(inside.sum())} found")
            size = min(d, 2 * size)
    finally:
        shared.unpersist()


def _solve(spark: SparkSession, shared, points: np.ndarray, weights: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The sum over the nodes of Re(weight * (point - matrix)^-1 block); each node is a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shifted = points[i] * np.eye(len(block)) - shared.value
                part = (weights[i] * np.linalg.solve(shifted, block.astype(complex))).real
                yield pa.record_batch({"node": pa.array([i], pa.int32()), "part": pa.array([part.tobytes()], pa.binary())})

    found = spark.range(0, len(points), 1, len(points)).mapInArrow(run, "node int, part binary").collect()
    parts = [np.frombuffer(r.part).reshape(block.shape) for r in sorted(found)]
    return np.sum(parts, axis=0)
