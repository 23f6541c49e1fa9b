"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import bpe, jaccard, licenses, linededup, mixing, multiindex, quality, spelling, suffixdedup, topk, urlfilter, warc, whitening
from newsflow.session import prepare, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def query(run):
    QUERIES[run.__name__] = lambda spark, folder: run(prepare(spark), folder)
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_topk(spark, folder):
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query
def op2_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = linededup.remove_repeated_chunks(docs)
    counts = [c for c in linededup.NEW if c != "clean_text"]
    return rows.select("doc_id", *counts, F.sha2("clean_text", 256).alias("clean_sha256"))


@query
def op3_suffix_dedup(spark, folder):
    rows = suffixdedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op4_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = bpe.decode(bpe.encode(docs, TOKENIZER).select("doc_id", "ids"), TOKENIZER)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_warc(spark, folder):
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


@query
def op6_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_licenses(spark, folder):
    rows = licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_paragraphs", F.array_join("licenses", ",").alias("licenses"), F.size("license_paragraphs").cast("long").alias("n_notices"))


@query
def op8_url_filter(spark, folder):
    """The list holds the addresses of pages whose document is labelled toxic."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    toxic = table(spark, folder, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.join(toxic, "page_id", "left_semi").select("url")
    return urlfilter.judge_urls(pages, listed, URL_RULES).select("page_id", *urlfilter.NEW)


@query
def op9_jaccard(spark, folder):
    return jaccard.link_documents(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op10_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    # a line in more than 10 documents of a source is common, however large the source
    return quality.quality_rules(docs, enough_docs=10).select("doc_id", *[c for c in quality.NEW if c != "clean_text"])


@query
def op11_spelling(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_whitening(spark, folder):
    return whitening.whiten(whitening.integer_vectors(table(spark, folder, "embeddings")))


@query
def op13_neighbours(spark, folder):
    vectors = multiindex.usable(table(spark, folder, "embeddings"))
    return multiindex.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query
def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
