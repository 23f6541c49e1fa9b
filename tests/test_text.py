"""Column functions over text."""

import pytest
from pyspark.sql import functions as F

from newsflow.functions import text


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a</p><p>b</p>", "ab"),
        ("<p>x &amp;amp; y</p>", "x &amp; y"),
        ('<script>var t="</p>";</script><p>ok</p><!-- c -->', "ok"),
        ("<p> a　 b&nbsp;c </p>", "a b c"),
        ("<STYLE>p{}</STYLE>x<br/>y", "xy"),
        ("caf&eacute; &#233; &#x4E2D; &#128512; &apos;", "café é 中 😀 '"),
        ("&#38;lt; &#x26;gt; &amp;#65;", "&lt; &gt; &#65;"),
        ("&lt;b&gt; &unknown; &amp", "<b> &unknown; &amp"),
        ("&#0; &#55296; &#1114112;", "&#0; &#55296; &#1114112;"),
        ("no markup", "no markup"),
        ("", ""),
        (None, None),
    ],
)
def test_html_to_text(spark, html, expected):
    assert one(spark, html, text.html_to_text) == expected


@pytest.mark.parametrize("value, blank", [(None, True), ("", True), ("  ", True), ("　", True), (" \t", True), ("a", False)])
def test_is_blank(spark, value, blank):
    assert one(spark, value, text.is_blank) is blank


def test_truncate_and_preview(spark):
    assert one(spark, "銅" * 501, text.truncate) == "銅" * 500
    assert one(spark, "x" * 60, text.preview) == "x" * 60
    assert one(spark, "x" * 61, text.preview) == "x" * 60 + "..."


@pytest.mark.parametrize(
    "value, found",
    [
        ("銅 価格", True),
        ("銅価格が上昇", False),
        ("copper", True),
        ("coppery", False),
        ("a_copper", False),
        ("coppery copper!", True),
        ("(copper)", True),
        ("écopper", False),
    ],
)
def test_contains_word(spark, value, found):
    assert one(spark, value, lambda c: text.contains_word(c, ["copper", "銅"])) is found


def test_ngrams(spark):
    assert one(spark, "The a Copper-price, 銅価 x", text.ngrams) == [
        "the", "copper", "price", "銅価", "the copper", "copper price", "price 銅価",
    ]
    assert one(spark, "Word", text.ngrams) == ["word"]
    assert one(spark, "a !", text.ngrams) == []


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<a title="x > y">t</a>', "t"),
        ("<a title='x > \"y'>t</a>", "t"),
        ("a < b and c > d", "a < b and c > d"),
        ("before<!-- no <b> end", "before"),
        ("x<script>if (a < b) '</b>' more", "x"),
        ("x<style media='a>b'>p {}</style >y", "xy"),
        ("x<script>a</style>b</SCRIPT>y", "xy"),
        ("<!DOCTYPE html><?xml version='1'?><p class=a>t</p>", "t"),
        ('<a title="open>t</a>', "t"),
        ("<p>5 &lt; 6</p><br/>", "5 < 6"),
        ("", ""),
        (None, None),
    ],
)
def test_markup(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(text.html_to_text(F.col("html"))).first()[0] == expected
