"""Rule sets from JSON."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.rules import Rules

_RULES = "map<string, struct<score: int, terms: array<string>>>"


def priority_rules(config: Column) -> Column:
    """``keywords`` of a configuration text, as a map of level to score and terms."""
    return F.from_json(config, f"struct<keywords: {_RULES}>")["keywords"]


def rule_rows(df: DataFrame, config: str) -> DataFrame:
    """One row per term of the configuration in column ``config``: level, score, term."""
    levels = df.select(F.explode(priority_rules(F.col(config))).alias("level", "rule"))
    return levels.select("level", F.col("rule.score").alias("score"), F.explode("rule.terms").alias("term"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule rows of a configuration file with ``news_filtering.priority_scoring``."""
    schema = f"news_filtering struct<priority_scoring: struct<keywords: {_RULES}>>"
    config = spark.read.schema(schema).json(path, multiLine=True)
    levels = config.select(F.explode("news_filtering.priority_scoring.keywords").alias("level", "rule"))
    return levels.select("level", F.col("rule.score").alias("score"), F.explode("rule.terms").alias("term"))


def as_priority_terms(rows: list) -> dict:
    """Collected rule rows as the rule set that the scoring functions take."""
    levels: dict = {}
    for row in rows:
        levels.setdefault(row.level, {"score": row.score, "terms": []})["terms"].append(row.term)
    return levels


_CONFIG = f"""
news_filtering struct<
  priority_scoring: struct<enabled: boolean, minimum_score: int, keywords: {_RULES}, category_minimum_scores: map<string, int>>,
  source_filtering: struct<enabled: boolean, excluded_sources: array<string>>,
  duplicate_detection: struct<enabled: boolean, similarity_threshold: double, check_window_hours: int>>,
text_processing struct<max_headline_length: int>"""


def whole_rules(config: DataFrame, base: Rules | None = None) -> Rules:
    """The rule set of a one-row table of a configuration's columns; what it leaves out is as in ``base``.

    Scoring, source filtering and duplicate detection that are not enabled do nothing.
    """
    base = base or Rules()
    held = config.first().asDict(recursive=True)
    filtering = held.get("news_filtering") or {}
    scoring, sources, duplicates = (filtering.get(n) or {} for n in ("priority_scoring", "source_filtering", "duplicate_detection"))
    off = lambda section: section.get("enabled") is False
    given = {
        "priority_terms": scoring.get("keywords"),
        "category_minimum": {} if off(scoring) else scoring.get("category_minimum_scores"),
        "minimum_score": 0 if off(scoring) else scoring.get("minimum_score"),
        "excluded_sources": [] if off(sources) else sources.get("excluded_sources"),
        "window_hours": duplicates.get("check_window_hours"),
        "similarity": duplicates.get("similarity_threshold"),
        "max_headline_length": (held.get("text_processing") or {}).get("max_headline_length"),
    }
    rules = replace(base, **{k: v for k, v in given.items() if v is not None})
    return replace(rules, similarity=None) if off(duplicates) else rules


def read_whole_rules(spark: SparkSession, path: str, base: Rules | None = None) -> Rules:
    """:func:`whole_rules` of a configuration file."""
    return whole_rules(spark.read.schema(_CONFIG).json(path, multiLine=True).limit(1), base)
