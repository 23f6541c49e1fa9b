"""Lines shared within a host, by an absolute count and through the pipeline."""

import pytest

import corpus_pipeline
from newsflow.llm import quality
from newsflow.llm.queries import QUERIES

SHARED = "read more of our stories on the front page of this paper every day 2024"


def _words(i, n):
    return " ".join(f"w{i}x{j}" for j in range(n)).translate(str.maketrans("0123456789", "abcdefghij"))  # digits count as 0


def _rows():
    """A hot source of 1,000 documents, 5 % of them with a shared line, and a small source."""
    rows = [(i, f"{_words(i, 30)}\n{SHARED if i % 20 == 0 else _words(2 * 10**6 + i, 3)}\n{_words(10**6 + i, 30)}", "hot") for i in range(1, 1001)]
    rows += [(2000 + i, f"{SHARED}\n{_words(2000 + i, 60)}", "small") for i in range(8)]
    # 65 words, 10 of their own: depleted without its shared lines
    mostly = "\n".join(_words(5 * 10**6 + k, 11) for k in range(5))
    rows += [(3000 + i, f"{mostly}\n{_words(3000 + i, 10)}", "hot") for i in range(40)]
    return rows


@pytest.mark.parametrize("host_lines", [1000, 0])
def test_an_absolute_count_does_not_grow_with_the_host(spark, monkeypatch, host_lines):
    monkeypatch.setattr(quality, "HOST_LINES", host_lines)
    df = spark.createDataFrame(_rows(), "doc_id long, text string, source string").repartition(3)
    for r in quality.quality_rules(df, enough_docs=20).collect():
        if r.doc_id < 2000 and r.doc_id % 20 == 0:
            assert SHARED not in r.clean_text and r.n_common_words == len(SHARED.split()) and r.kept
        elif r.doc_id < 3000:
            assert r.clean_text == r.text and r.n_common_words == 0 and r.kept  # eight documents are too few
        else:
            assert not r.base_failed and not r.kept and r.clean_text == r.text.split("\n")[-1]


def test_the_registered_query_rejects_depleted_documents(spark, tmp_path):
    spark.createDataFrame(_rows(), "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.kept, r.base_failed) for r in QUERIES["op10_quality"](spark, str(tmp_path)).collect()}
    assert {i for i, (kept, _) in got.items() if not kept} == {3000 + i for i in range(40)}
    assert not any(failed for _, failed in got.values())


def test_the_pipeline_rejects_depleted_documents(spark):
    rows = [(i, t, "en", s, len(t)) for i, t, s in _rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, df, "").collect()}
    assert set(got) == {i for i, *_ in rows if i < 3000}
    assert not any(SHARED in got[i] for i in got if i < 2000)


@pytest.mark.parametrize("host_lines", [1000, 0])
def test_both_ways_to_meet_common_lines_on_awkward_tables(documents, spark, monkeypatch, host_lines):
    monkeypatch.setattr(quality, "HOST_LINES", host_lines)
    out = quality.quality_rules(documents, common_docs=0, enough_docs=1)
    assert out.count() == documents.count()
    nulls = [(i, f"shared\n\nshared\nown {'z' * i}\n", None) for i in range(30)]
    df = spark.createDataFrame(nulls, "doc_id long, text string, source string")
    assert {r.clean_text for r in quality.quality_rules(df, enough_docs=20).collect()} == {f"\nown {'z' * i}\n" for i in range(30)}
