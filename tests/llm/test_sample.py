"""The training sample: the texts of the smallest hashes, copies counted, without a sort of whole texts."""

from pyspark.sql import functions as F

from newsflow.llm import licenses


def test_sample_takes_the_smallest_hashes_and_sorts_no_texts(spark, monkeypatch):
    rows = [(i, f"text number {i % 40}\nmore of it {i % 40}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ordered = df.orderBy(F.xxhash64("text", F.lit(7)), "text").limit(12).collect()
    sorts, kind = [], type(df)
    order = kind.orderBy
    monkeypatch.setattr(kind, "orderBy", lambda self, *c, **k: (sorts.append((self.columns, c)), order(self, *c, **k))[1])
    lines = {p for _, t in rows for p in t.split("\n")}
    plain = [p for f, p in licenses.training_paragraphs(df, 12, 7) if f == licenses.UNKNOWN and p in lines]
    want = [p for r in ordered for p in r.text.split("\n")]
    assert sorted(plain) == sorted(want)
    assert all("text" not in c for _, c in sorts) and (["at"], ("at",)) in sorts
