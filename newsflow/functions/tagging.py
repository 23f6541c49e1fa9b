"""Column functions that tag and score articles from rule sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import contains_any, contains_word


def full_text(headline: Column, body: Column) -> Column:
    """Headline and body in lower case; a missing body adds nothing."""
    return F.lower(F.concat_ws(" ", headline, F.coalesce(body, F.lit(""))))


def detect_categories(
    text: Column, headline: Column, by_word: dict, by_phrase: dict, requested: str | None = None
) -> Column:
    """Category tags in rule order, the requested one first.

    ``text`` is :func:`full_text`; words match whole, phrases anywhere in the headline.
    """
    tags = [F.lit(requested)] if requested else []
    tags += [F.when(contains_word(text, words), F.lit(cat)) for cat, words in by_word.items()]
    tags += [F.when(contains_any(F.lower(headline), terms), F.lit(cat)) for cat, terms in by_phrase.items()]
    return F.array_distinct(F.array_compact(F.array(*tags)))


def searched_categories(text: Column, terms: dict) -> Column:
    """All categories whose search terms occur in ``text``, in rule order."""
    hits = [F.when(contains_any(text, words), F.lit(cat)) for cat, words in terms.items()]
    return F.array_compact(F.array(*hits))


def category_search(text: Column, terms: dict, category: str, language: Column, wanted: str | None = None) -> Column:
    """Predicate of one category search, within one language if ``wanted``; unknown categories find nothing."""
    hit = contains_any(text, terms.get(category, []))
    return hit & (language == wanted) if wanted else hit


def detect_urgency(text: Column, words: dict) -> Column:
    """Smallest level with a matching substring, else 3."""
    level = F.lit(3)
    for rank in sorted(words, reverse=True):
        level = F.when(contains_any(text, words[rank]), F.lit(rank)).otherwise(level)
    return level


def priority_score(text: Column, levels: dict) -> Column:
    """Sum of the level score over all terms that occur, each term once."""
    score = F.lit(0)
    for rule in levels.values():
        for term in rule["terms"]:
            score = score + F.when(text.contains(term.lower()), F.lit(rule["score"])).otherwise(F.lit(0))
    return score


def required_score(categories: Column, minimum: dict) -> Column:
    """Highest minimum among the article's categories, at least 0."""
    need = F.lit(0)
    for cat, score in minimum.items():
        need = F.greatest(need, F.when(F.array_contains(categories, cat), F.lit(score)).otherwise(F.lit(0)))
    return need


def split_categories(joined: Column) -> Column:
    """Tags of a comma-joined list, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(joined, ","), lambda c: F.trim(c)), lambda c: c != "")


def join_categories(categories: Column) -> Column:
    return F.array_join(categories, ",")
