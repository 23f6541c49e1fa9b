"""Multi-index hashing against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import multiindex


def _brute(rows, queries, k):
    out = {}
    for q, asked in queries:
        found = sorted({(-float(np.dot(v, asked)), i) for i, v in rows if i != q and len(v) == len(asked)})[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def _found(spark, rows, query_ids, k, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("score", F.lit("x")).repartition(3)
    good = multiindex.usable(df)
    got = multiindex.nearest(good, good.where(F.col("vec_id").isin(query_ids)), k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def _recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in found}) for q, found in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["even", "clusters", "norms", "narrow"])
def test_recall_against_brute_force(spark, kind):
    r = np.random.RandomState(8)
    vectors = r.standard_normal((3000, 5 if kind == "narrow" else 32))
    if kind == "clusters":
        vectors[:1000] = vectors[0] + 0.05 * vectors[:1000]
    if kind == "norms":
        vectors *= np.exp(r.standard_normal(3000))[:, None]
    rows = list(enumerate(vectors.tolist()))
    ids = list(range(0, 3000, 30))
    got, want = _found(spark, rows, ids, 10), _brute(rows, [rows[i] for i in ids], 10)
    assert all(len(found) == 10 for found in got.values()) and len(got) == len(ids)
    assert _recall(got, want) >= 0.9
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([float(np.dot(vectors[i], vectors[q])) for i, _ in found])
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_every_code_within_the_radius():
    r = np.random.RandomState(9)
    vectors = r.standard_normal((2000, 20))
    code = multiindex.Code.learn(vectors, float(np.sqrt((vectors**2).sum(axis=1)).max()))
    index = multiindex._Index(np.arange(2000), vectors, code)
    for asked in code.of_queries(vectors[:20]):
        for radius in (0, 1, 2, 5, 9, 20):
            apart = np.unpackbits(index.codes ^ asked, axis=1).sum(axis=1)
            assert index.within(asked, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_awkward_rows(spark):
    rows = [(i, [1.0, 2.0, float(i % 3)]) for i in range(40)]
    rows += [(1, rows[1][1]), (2, [9.0, 9.0, 9.0]), (50, [0.0, 0.0, 0.0]), (51, None), (52, [1.0, None, 1.0]), (53, [math.nan] * 3), (54, [-math.inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (60, []), (61, [1.0, 1.0]), (62, [1.0, 3.0]), (63, [-1.0] * 4)]
    good = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    ids = [0, 5, 50, 60, 61, 63]
    got = _found(spark, rows, ids, 20)
    want = {q: found for q, found in _brute(good, [x for x in good if x[0] in ids], 20).items() if found}
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}
    df = multiindex.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert multiindex.nearest(df.where("false"), df).count() == 0
    assert multiindex.nearest(df, df.where("false")).count() == 0
    assert multiindex.nearest(df.limit(1), df.limit(1)).count() == 0
