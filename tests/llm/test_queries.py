"""Registered queries beside their SQL, native plans, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import connect, differences
from newsflow.llm import mixing, quality
from newsflow.llm.oracle import ORACLE
from newsflow.llm.queries import QUERIES
from newsflow.llm.tables import keep

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(connect(FOLDER), name, df)[0] == ""
    if name.split("_")[0] in ("op2", "op6", "op8", "op10"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan


def test_pipeline_stages(spark):
    """Each stage works on what the one before kept, with the columns of documents; written and read again, as the job does."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, docs, FOLDER), name)
        rows, before = out.collect(), docs.collect()
        ids, kept = {r.doc_id for r in before}, {r.doc_id for r in rows}
        assert kept and kept <= ids
        if name != "tokens":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        if name == "quality_rules":
            assert kept == {r.doc_id for r in quality.quality_rules(docs, enough_docs=corpus_pipeline.ENOUGH_DOCS).where("kept").collect()}
        if name == "mix_sources":
            taken = {r.doc_id: r.taken // r.size for r in mixing.mix_sources(docs).collect() if r.taken}
            assert taken == {i: sum(r.doc_id == i for r in rows) for i in kept}
        if name == "tokens":
            assert all(r.exact and r.n_tokens == len(r.ids) for r in rows) and len(rows) == len(before)
        docs = out


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_tables(spark, name):
    """Nulls in every column, empty and repeated rows, a column that clashes, and no rows at all."""
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, None, "en", "s", None), (3, "", None, None, 0), (None, text + " x", "de", None, 1), (4, "\n \n", "en", "t", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit("mine"))
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, df, "")
    assert {r.doc_id for r in out.collect()} <= {1, 2, 3, 4, None}
    assert stage(spark, df.where("false"), "").count() == 0
