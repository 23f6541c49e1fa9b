"""Licence notices across lines, short ones, and wordings that no template holds."""

import textwrap

import pytest

from newsflow.llm import licenses

HEADERS = {
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
    "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell it.",
}
SHORT = {
    "The MIT License (MIT)": "MIT",
    "MIT License": "MIT",
    "This tool may be used under the conditions of the MIT licence.": "MIT",
    "You may copy these files as the Mozilla Public License 1.1 allows.": "MPL",
    "Distribution is governed by the Eclipse Public License 1.0": "EPL",
    "Its source is available to you under a BSD licence.": "BSD",
    "zlib License": "zlib",
}
NONE = ("The general public was not admitted.", "He lost his fishing license\nin the terms of last year.", "Two lines\nof no interest.", "An attribution of the\npicture is missing.")


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return licenses.train(licenses.training_paragraphs(docs, 100, 7))


def _found(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(df, model).collect()}
    return [rows[i] for i in range(len(texts))]


@pytest.mark.parametrize("width", [50, 70])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_headers(spark, model, width, mark):
    wrapped = {f: "\n".join(mark + x for x in textwrap.wrap(t, width)) for f, t in HEADERS.items()}
    texts = [f"import this\n\n{t}\n\nplain text follows here" for t in wrapped.values()]
    for family, text, row in zip(wrapped, texts, _found(spark, model, texts), strict=True):
        assert row.licenses == [family]
        for n in row.license_paragraphs:
            assert n.place >= 2 and n.paragraph in text and text.split("\n")[n.place] == n.paragraph.split("\n")[0]


def test_short_and_held_out_wordings(spark, model):
    got = _found(spark, model, [*SHORT, *NONE])
    assert [r.licenses for r in got] == [*([f] for f in SHORT.values()), *([] for _ in NONE)]


def test_blank_lines_part_notices(spark, model):
    text = "This program is free software: you can redistribute\n\nit and/or\n\nmodify it under the terms of\n\nthe GNU General"
    assert _found(spark, model, [text])[0].licenses == []
