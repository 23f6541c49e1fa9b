"""Tags, urgency, scores and searches with the news vocabulary."""

import pytest
from pyspark.sql import functions as F

from newsflow.functions import tagging
from newsflow.plans.ingest import filter_min_score, tag_articles
from newsflow.rules import SEARCH_TERMS, Rules

CASES = [
    ("BREAKING: Copper strike hits LME supply", ["COPPER"], 1, 20),
    ("Major report on tin demand outlook", ["TIN"], 2, 9),
    ("Lead and zinc stocks rise", ["ZINC", "LEAD", "EQUITY"], 3, 0),
    ("Palmer supermarket leading", [], 3, 7),
    ("Machinations in forex", ["FOREX"], 3, 5),
    ("Supply cut at nickel mine", ["NICKEL"], 3, 15),
    ("The exchange rate and commodities", ["FOREX", "COMMODITIES"], 3, 0),
    ("銅 価格", ["COPPER"], 3, 0),
    ("銅価格が上昇", [], 3, 0),
    ("速報 ニッケル 急騰", ["NICKEL"], 1, 0),
    ("ＮＹ市場サマリー（17日）ドル週間で下落、利回り上昇　株反発", ["NY_MARKET"], 3, 0),
    ("UPDATE 1-ＮＹ市場サマリー（16日）米国株下落、ドル下落、2年債利回り3年超ぶり低水準", ["NY_MARKET"], 3, 0),
    ("NY市場サマリー（１６日）", ["NY_MARKET"], 3, 0),
    ("ny市場サマリー（１６日）", ["NY_MARKET"], 3, 0),
    ("ＮＹ株式市場の動向", [], 3, 0),
    ("NYダウ、最高値更新", [], 3, 0),
]


def articles(spark, rows):
    return spark.createDataFrame(rows, "story_id string, headline string, body_text string")


def test_tag_articles(spark):
    rows = [(str(i), c[0], None) for i, c in enumerate(CASES)]
    got = {r.story_id: r for r in tag_articles(articles(spark, rows), Rules()).collect()}
    for i, (headline, categories, urgency, score) in enumerate(CASES):
        row = got[str(i)]
        assert (row.headline, row.categories, row.urgency_level, row.priority_score) == (
            headline, categories, urgency, score,
        )


def test_body_counts_but_not_for_headline_phrases(spark):
    row = tag_articles(articles(spark, [("1", "News", "copper ny市場サマリー strike")]), Rules()).first()
    assert (row.categories, row.priority_score) == (["COPPER"], 10)


def test_requested_category_goes_first_and_once(spark):
    df = articles(spark, [("1", "BREAKING: Copper strike", None), ("2", "tin and zinc", None)])
    got = {r.story_id: r.categories for r in tag_articles(df, Rules(), requested="TIN").collect()}
    assert got == {"1": ["TIN", "COPPER"], "2": ["TIN", "ZINC"]}


@pytest.mark.parametrize(
    "minimum, overall, kept",
    [({}, 0, {"1", "2", "3"}), ({}, 5, {"1", "2"}), ({"COPPER": 20, "TIN": 10}, 0, {"1", "3"}), ({"COPPER": 21}, 0, {"2", "3"})],
)
def test_filter_min_score(spark, minimum, overall, kept):
    df = articles(
        spark, [("1", "Copper strike hits LME supply", None), ("2", "report on tin demand outlook", None), ("3", "other", None)]
    )
    rules = Rules(category_minimum=minimum, minimum_score=overall)
    got = filter_min_score(tag_articles(df, rules), rules)
    assert {r.story_id for r in got.collect()} == kept


def test_category_search(spark):
    df = spark.createDataFrame(
        [("1", "lead metal prices", "en"), ("2", "leading", "en"), ("3", "鉛", "ja")], "story_id string, t string, language string"
    )

    def found(category, language=None):
        hit = tagging.category_search(F.col("t"), SEARCH_TERMS, category, F.col("language"), language)
        return {r.story_id for r in df.where(hit).collect()}

    assert found("LEAD") == {"1", "3"}
    assert found("LEAD", "en") == {"1"}
    assert found("NO_SUCH") == set()


def test_split_categories(spark):
    df = spark.createDataFrame([("COPPER, TIN ,,",), ("",)], "c string")
    got = [r[0] for r in df.select(tagging.split_categories(F.col("c"))).collect()]
    assert got == [["COPPER", "TIN"], []]
