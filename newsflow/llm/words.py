"""Column expressions on words and lines, as the native operators count them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the characters that separate words.
SPACES = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(name: str) -> Column:
    """A text column, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def n_symbols(text: Column) -> Column:
    """Characters of ``#*$%&|<>``."""
    return F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def without_lines(lines_: Column, gone: Column) -> Column:
    """Lines but those at the places ``gone`` (sorted, distinct, from 0). Linear in the lines."""
    last = lambda i: F.coalesce(F.get(gone, i - 1), F.lit(-1))
    steps = F.transform(gone, lambda at, i: F.concat(F.array_repeat(F.lit(True), at - last(i) - 1), F.array(F.lit(False))))
    marked = F.zip_with(lines_, F.flatten(steps), lambda x, stays: F.struct(x.alias("x"), F.coalesce(stays, F.lit(True)).alias("stays")))
    return F.transform(F.filter(marked, lambda m: m["stays"]), lambda m: m["x"])
