"""Operators against brute force, and on awkward tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsflow.llm import bpe, jaccard, licenses, linededup, mixing, quality, suffixdedup, topk, urlfilter, warc
from newsflow.llm.queries import TOKENIZER, URL_RULES
from newsflow.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
OPERATORS = {
    "lines": linededup.remove_repeated_chunks,
    "suffixes": suffixdedup.remove_repeats,
    "encode": lambda df: bpe.encode(df, TOKENIZER),
    "mixing": mixing.mix_sources,
    "licenses": licenses.scan_licenses,
    "jaccard": jaccard.link_documents,
    "quality": quality.quality_rules,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_awkward_and_empty_tables(documents, name):
    out = OPERATORS[name](documents)
    rows = out.collect()
    assert len(rows) == documents.count()
    repeated = [r for r in rows if r.doc_id == 2]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert OPERATORS[name](documents.where("false")).count() == 0


def test_cover_holds_every_difference():
    cover = suffixdedup.COVER
    assert {(a - b) % suffixdedup.PERIOD for a in cover for b in cover} == set(range(suffixdedup.PERIOD))


def test_regular_words_of_one_length_stay_apart(spark):
    """Thue-Morse words and their complements, on which polynomial hashes modulo 2^64 collide."""
    word = "a"
    rows = []
    for n in range(13):
        if n >= 8:
            rows += [(2 * n, word), (2 * n + 1, word.translate({97: "b", 98: "a"}))]
        word += word.translate({97: "b", 98: "a"})
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id and r.n_links == 0 for r in got)


@pytest.mark.parametrize("shuffles", [3, 16])
def test_suffix_row_groups_do_not_follow_the_settings(spark, shuffles, monkeypatch):
    kept = []
    plain = suffixdedup.keep
    monkeypatch.setattr(suffixdedup, "keep", lambda df, name: kept.append((name, plain(df, name))) or kept[-1][1])
    rows = [(i, f"{i % 7} " * 40 + "shared " * 60 + str(i)) for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")).count()
        ties = [df.count() for name, df in kept if name == "ties"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(ties) == 4 and max(ties) <= 12  # a row group for each of 4 tasks and kind, at most


def _repeats(rows, width=100):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            part = data[p : p + width]
            if part in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(part)
        out[i] = bytes(c for c, g in zip(data, gone, strict=True) if not g)
    return out


def test_suffixes_against_brute_force(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcdeé ") for _ in range(r.randint(50, 900))) for _ in range(10)]
    rows = []
    for i in range(150):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            text[r.randrange(len(text))] = r.choice("#a")
        own = "".join(r.choice("xyz") for _ in range(r.randint(0, 120)))
        rows.append((i, r.choice(["".join(text), own + "".join(text)[r.randrange(50) :] + own, "ab" * r.randint(0, 300), None])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: bytes(x.kept) for x in suffixdedup.remove_repeats(df).select("doc_id", "kept").collect()}
    assert got == _repeats(rows)


def _shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else ({tuple(words)} if words else set())


@pytest.mark.parametrize("block", [64, 256])
def test_jaccard_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", block)
    monkeypatch.setattr(jaccard, "CLUSTER_BLOCK", block)
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "The"]
    base = [[r.choice(words) for _ in range(r.randint(1, 120))] for _ in range(12)] + [[r.choice(words) for _ in range(4000)]]
    rows = []
    for i in range(200):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 3) * (1 + len(text) // 200)):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((3 * i + 1, None if r.random() < 0.03 else r.choice([" ", "\n"]).join(text)))
    sets = [(i, _shingles(t)) for i, t in rows]
    parent, links = {i: i for i, _ in sets}, {i: 0 for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[n + 1 :]:
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                links[a] += 1
                links[b] += 1
                u, v = sorted((root(a), root(b)))
                parent[v] = u
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.n_links) for x in jaccard.link_documents(df).collect()}
    assert got == {i: (len(s), root(i), links[i]) for i, s in sets}


def test_tokens_equal_the_library(spark):
    r = random.Random(1)
    letters = [chr(c) for c in [*range(0x250), *range(0x300, 0x400), 0x2000, 0x3000, 0x4E00, 0x1F600, 0x660, 0x2460, 0xFFFD]]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(500)]
    texts += ["a" * 5000, "ab" * 900, " " * 300, "aananan Thinginging", "<|endoftext|>x<|endoftext|>", "I'll don't 'S", "\r\n\t x", "", None]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(df, TOKENIZER), TOKENIZER).collect()
    for row in rows:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == want and row.decoded == library.decode(want, skip_special_tokens=False)
    odd = [[r.randrange(50257) for _ in range(9)] for _ in range(200)] + [[], None, [-1, 10**6, None]]
    got = bpe.decode(spark.createDataFrame(list(enumerate(odd)), "i int, ids array<int>"), TOKENIZER).collect()
    for row in got:
        want = library.decode([i for i in row.ids or [] if i is not None and 0 <= i < 50257], skip_special_tokens=False)
        assert row.decoded == want


def test_pieces_hold_all_rows_within_the_limit():
    texts = ["ab", None, "", "x" * 50, "é", "abc", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array([{"text": t} for t in texts])], ["row"])
    pieces = list(bpe._pieces([batch, batch.slice(0, 0)], bpe._text_bytes, 5))
    assert [r["row"]["text"] for p in pieces for r in p.to_pylist()] == texts
    assert [p.num_rows for p in pieces] == [3, 1, 2, 1]


@pytest.mark.parametrize("rows_at_once", [60, 5000])
def test_topk_against_brute_force(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(topk, "SHARD_ROWS", rows_at_once)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    random_ = np.random.RandomState(3)
    rows = [(i, random_.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(100)]  # many equal vectors
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (None, [1.0] * 6), (405, [1.0] * 4)]
    df = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<double>")
    vectors = topk.quantised(df)
    got = {}
    for x in topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    whole = {i: [int(np.floor(64 * c)) for c in v] for i, v in rows[:400]}
    for q in range(0, 400, 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:20]
        assert got[q] == {n + 1: (i, -s) for n, (s, i) in enumerate(scores)}
    assert topk.top_k(vectors.where("false"), vectors.where("false")).count() == 0


def test_archive_round_trip(spark):
    big = "<p>é</p>" * 50
    rows = [(5, "http://a/\r\nx", big), (3, None, big), (None, "u", big), (4, "u", None), (2, "u", ""), (1, "u", "small"), (9, "u", "small"), (9, "u", "small")]
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    archive = warc.read_archive(spark, path)
    got = archive.collect()
    assert sorted((bytes(r.payload).decode() for r in got)) == sorted(h or "" for _, _, h in rows)
    kinds = {r.page_id: (r.record_type, r.refers_to, len(r.payload)) for r in got}
    assert kinds[3] == ("response", None, 450) and kinds[5] == ("revisit", 3, 450) and kinds[None] == ("revisit", 3, 450)
    assert kinds[1][0] == kinds[9][0] == kinds[2][0] == "response"
    for r in warc.records(archive).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert body == bytes(r.block) + b"\r\n\r\n" and size == len(r.block)
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    warc.export_files(archive, path + "/files")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path + "/files").collect())
    assert raw.count(b"WARC/1.1\r\n") == len(rows) == raw.count(b"WARC-Date: 1970")
    assert {(r.page_id, r.url) for r in got} == {(i, u or "") for i, u, _ in rows}  # line breaks too
    ids = {(r.page_id, r.url): re.search("WARC-Record-ID: (<.*?>)", r.header)[1] for r in got}
    assert len(set(ids.values())) == len(ids)
    refers = {m for r in got for m in re.findall("WARC-Refers-To: (<.*?>)", r.header)}
    assert refers == {ids[3, ""]}


def test_archive_of_an_empty_table_and_clashing_columns(spark):
    df = spark.sql("SELECT 1L AS page_id, 'u' AS url, repeat('x', 200) AS html, 'a' AS digest, 'b' AS holder, 'c' AS at, 'd' AS payload")
    for table, n in ((df, 1), (df.where("false"), 0), (df.union(df), 2)):
        path = scratch_path(spark, "warc")
        warc.write_archive(table, path)
        assert [(r.page_id, r.record_type, len(r.payload)) for r in warc.read_archive(spark, path).collect()] == n * [(1, "response", 200)]


def test_mix_hits_targets(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 60), r.choice(["b", "a", "a", "a", None, "c"])) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(df).collect()
    by = {}
    for x in out:
        assert x.taken <= 2 * x.size and (x.size == 0 or x.taken % x.size == 0)
        by.setdefault(x.source, []).append(x)
    total = sum(x.size for x in out)
    assert abs(sum(xs[0].target for xs in by.values()) - 1.5 * total) < 1e-6
    for xs in by.values():
        assert xs[0].source_size == sum(x.size for x in xs) and xs[0].target <= 2 * xs[0].source_size + 1e-9
        assert abs(sum(x.taken for x in xs) - xs[0].target) <= 60
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix_sources(df.repartition(7)).collect()))


def test_license_classifier_on_held_out_notices(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = licenses.scan_licenses(df).collect()
    hint = re.compile(r"(?im)^.*\b(?:licensed|released) under.*$")
    right = sum(bool(r.licenses) == bool(hint.search(r.text or "")) for r in rows)
    assert right / len(rows) > 0.99
    model = licenses.train(licenses.training_paragraphs(df, 100, 7))
    held = ["this file is licensed under the Apache License, Version 2.0", "a plain sentence about the sea", "he got a fishing license last year"]
    assert [f for f, _ in licenses.predict(held, model)] == ["Apache", "unknown", "unknown"]


def test_urls(spark):
    rows = [
        (1, "http://a.example.net/en/1"), (2, "http://a.example.net/de/1"), (3, "http://Example.COM/de/x#y"), (4, "http://www.b.org/fr/"),
        (5, "http://c.test/p/?q=1"), (6, "https://www.c.test/p"), (7, None), (8, "no scheme"), (9, "http://x.net"), (10, "http://d.test/q"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "address": F.lit(2)})
    listed = spark.createDataFrame([("http://c.test/p/",), (None,), ("http://c.test/p",)], "url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(pages, listed, URL_RULES).collect()}
    assert got == {
        1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: ("example.com/de/", "block"), 4: ("org/fr/", "allow"), 5: (None, "block"),
        6: (None, "block"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"),
    }
    assert urlfilter.judge_urls(pages.where("false"), listed.where("false"), URL_RULES).count() == 0


def test_chunks_do_not_depend_on_what_stands_around_them(spark):
    """Two lines are always a chunk, and the chunks of a passage are the same wherever it stands."""
    r = random.Random(6)
    passage = [f"line {r.random()}" for _ in range(12)]
    texts = ["\n".join(passage), "\n".join(["own", "", *passage[:5], " ", *passage[5:], "other"]), "", "\n", "one", "\n\ntwo\n"]
    lines = spark.createDataFrame([(i, t.split("\n")) for i, t in enumerate(texts)], "id int, _lines array<string>")
    got = {x.id: {bytes(c.code): (c.place, c.upto) for c in x._chunks} for x in linededup._chunks(lines).collect()}
    assert set(got[0]) <= {hashlib.sha256("\n".join(passage[a:b]).encode()).digest() for a in range(12) for b in range(a + 2, min(12, a + 8) + 1)}
    pairs = {hashlib.sha256("\n".join(passage[a : a + 2]).encode()).digest() for a in range(11)}
    assert pairs <= set(got[0]) and pairs <= set(got[1])
    inner = {code for code, (_, upto) in got[0].items() if upto < 11 or got[0][code][0] == 10}
    assert len(inner & set(got[1])) >= len(inner) - 8  # but for those that the end of the text cut
    assert not any(got[i] for i in (2, 3, 4, 5))
