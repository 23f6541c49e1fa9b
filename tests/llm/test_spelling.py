"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from newsflow.llm import spelling


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def _words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]{7,}", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def _expected(rows):
    counts = _words(rows)
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if _near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = (form, n, len(near), counts.get(form))
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return {(w, form, root(w), n, near, form_n) for w, (form, n, near, form_n) in out.items()}


def _got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {tuple(r) for r in spelling.spelling_variants(df).collect()}


@pytest.mark.parametrize("alphabet", ["ab", "aàB", "abcdefg"])
def test_forms_against_brute_force(spark, alphabet):
    r = random.Random(len(alphabet))
    stock = ["".join(r.choice(alphabet) for _ in range(r.randint(7, 11))) for _ in range(60)]
    texts = [" ".join(r.choices(stock, weights=[1 / (k + 1) ** 2 for k in range(60)], k=r.randint(0, 90))) for _ in range(120)]
    rows = [*enumerate(texts), (None, texts[0]), (200, None), (201, ""), (3, texts[3]), (202, "sh÷rtest, digits7inside 中")]
    got = _got(spark, rows)
    assert got == _expected(rows)
    if len(alphabet) > 2:
        assert any(form for _, form, *_ in got)


def test_long_words(spark):
    """Words around and far above the longest of the trie, of one letter too."""
    r = random.Random(3)
    base = "".join(r.choice("abcd") for _ in range(4000))
    words = [base, base[:1999] + base[2000:], "x" + base, base[:-1] + "x", "é" * 90, "é" * 91, "é" * 92]
    for size in (63, 64, 65):
        words += [base[:size], base[:size] + "q", base[: size // 2] + "z" + base[size // 2 + 1 : size], "a" * size]
    rows = [(i, " ".join(words)) for i in range(40)]
    got = _got(spark, rows)
    assert got == _expected(rows)
    assert sum(near for *_, near, _ in got) > 20


def test_empty_table_and_clashing_columns(spark):
    rows = [(1, "wordone wordone wordona wordona", "x", 2), (2, "wordone " * 20, "y", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    assert {tuple(x) for x in spelling.spelling_variants(df).collect()} == _expected([r[:2] for r in rows])
    assert spelling.spelling_variants(df.where("false")).count() == 0
