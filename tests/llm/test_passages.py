"""Repeated passages of lines, planted at shifted places among unlike lines."""

import random

import pytest

import corpus_pipeline
from newsflow.llm import linededup


def _planted(seed=4, copies=40):
    """Texts of own lines; every passage of 2 to 8 lines stands in two or three of them, blank lines between some."""
    r = random.Random(seed)
    line = lambda: " ".join(f"w{r.randrange(10**6)}" for _ in range(r.randint(3, 20)))
    rows, passages = [], []
    for k in range(2, 9):
        for _ in range(copies):
            gap = r.choice(["\n", "\n", "\n\n"])
            passage = [line() for _ in range(k)]
            passages.append((len(rows), passage))
            for _ in range(r.randint(2, 3)):
                own = [[line() for _ in range(r.randint(0, 6))] for _ in range(2)]
                rows.append((len(rows), "\n".join([*own[0], gap.join(passage), *own[1]])))
            passages[-1] = (passages[-1][0], len(rows), passage)
    return rows, passages


@pytest.mark.parametrize("stage", [False, True])
def test_every_line_of_a_planted_passage_goes(spark, stage):
    rows, passages = _planted()
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if stage:
        got = {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, df.repartition(5), "").collect()}
    else:
        got = {x.doc_id: x.clean_text for x in linededup.remove_repeated_chunks(df.repartition(5)).collect()}
    for first, end, passage in passages:
        assert set(passage) <= set(got[first].split("\n"))
        for i in range(first + 1, end):
            own = [x for x in rows[i][1].split("\n") if x and x not in passage]
            assert [x for x in got.get(i, "").split("\n") if x] == own


def _pairs_met_before(rows):
    seen, out = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        worded = [p for p, x in enumerate(lines) if x.strip()]
        for a, b in zip(worded, worded[1:], strict=False):
            if (lines[a], lines[b]) in seen:
                gone |= set(range(a, b + 1))
            seen.add((lines[a], lines[b]))
        out[i] = ("\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone))
    return out


def test_passages_against_brute_force(spark):
    r = random.Random(8)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "d", "", " "]) for _ in range(r.randint(0, 7)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.clean_text, x.n_removed_lines) for x in linededup.remove_repeated_chunks(df).collect()}
    assert got == _pairs_met_before(rows)
    words = lambda texts: {x for t in texts for x in t.split("\n") if x.strip()}
    assert words(t for t, _ in got.values()) == words(t for _, t in rows)


def test_passages_of_awkward_and_empty_tables(documents, spark):
    out = linededup.remove_repeated_chunks(documents)
    rows = out.collect()
    assert len(rows) == documents.count()
    repeated = [r for r in rows if r.doc_id == 2]
    assert repeated[0] == repeated[1] and repeated[0].clean_text == ""
    assert linededup.remove_repeated_chunks(documents.where("false")).count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
