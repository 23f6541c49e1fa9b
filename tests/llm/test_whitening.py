"""Whitening against numpy's eigenvectors and exact sums."""

import math

import numpy as np
import pytest

from newsflow.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, n int"


def _expected(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in kept], dtype=np.int64), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    e, p = np.linalg.eigh(centred.T @ centred / n)
    e, p = e[::-1][:components], p[:, ::-1][:, :components]
    out = {}
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        out[i] = n, deviation, (np.array(x) - sums / n) @ p / np.sqrt(e)
    return out, e / np.trace(centred.T @ centred / n)


def _check(spark, rows, components=4, schema=SCHEMA):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], schema).repartition(3)
    got = whitening.whiten(whitening.integer_vectors(df), components).collect()
    want, explained = _expected(rows, components)
    assert len(got) == sum(len(w) for _, _, w in (want[i] for i, _ in rows if i in want))
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, whitened = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation if deviation < 2**63 else None)
        sign = signs.setdefault(r.component, np.sign(r.whitened * whitened[r.component - 1]))
        assert r.whitened == pytest.approx(sign * whitened[r.component - 1], rel=1e-8, abs=1e-8)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_against_numpy(spark):
    r = np.random.RandomState(4)
    vectors = (r.standard_normal((300, 12)) * np.linspace(3, 0.2, 12) @ r.standard_normal((12, 12))).tolist()
    rows = list(enumerate(vectors)) + [(400 + i, vectors[7]) for i in range(200)]
    rows += [(1, vectors[1]), (900, None), (901, [None] * 12), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11)]
    _check(spark, rows)


def test_large_entries_are_exact(spark):
    r = np.random.RandomState(5)
    _check(spark, list(enumerate((r.standard_normal((50, 3)) * 9e4).tolist())))  # beyond the exact products


def test_fewer_components_than_asked(spark):
    r = np.random.RandomState(6)
    _check(spark, list(enumerate(r.standard_normal((40, 2)).tolist())), components=2)
    line = [(i, [0.5 * i, i * 1.0, -0.25 * i]) for i in range(20)]
    df = spark.createDataFrame(line, "vec_id long, embedding array<double>")
    rows = whitening.whiten(whitening.integer_vectors(df)).collect()
    assert {x.component for x in rows} == {1} and all(x.explained == pytest.approx(1) for x in rows)


def test_tables_without_variance_and_of_two_lengths(spark):
    schema = "vec_id long, embedding array<float>"
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    for df in (equal, equal.where("false"), equal.limit(1), spark.createDataFrame([(1, []), (2, None)], schema)):
        assert whitening.whiten(whitening.integer_vectors(df)).count() == 0
    two = [(i, [float(i % 7), float(i % 3)]) for i in range(21)] + [(100 + i, [float(i), 1.0, float(i * i)]) for i in range(9)]
    rows = whitening.whiten(whitening.integer_vectors(spark.createDataFrame(two, schema))).collect()
    assert {(x.vec_id >= 100, x.n, x.component) for x in rows} == {(False, 21, 1), (False, 21, 2), (True, 9, 1), (True, 9, 2)}


def test_inertia_counts():
    r = np.random.RandomState(7)
    for n in (1, 2, 5, 30):
        a = r.standard_normal((n, n))
        a = a + a.T
        for shift in (-3.0, 0.0, 1.5):
            assert whitening.n_below(a, shift) == (np.linalg.eigvalsh(a) < shift).sum()
