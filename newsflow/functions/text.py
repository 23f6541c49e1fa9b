"""Column functions over text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"[\s\p{Z}]+"

# Named entities but the ampersand, which is decoded last.
_ENTITIES = {f"&{name};": chr(code) for name, code in name2codepoint.items() if name != "amp"}
_ENTITIES["&apos;"] = "'"


def is_blank(col: Column) -> Column:
    """NULL, empty or white space only, ideographic space included."""
    return col.isNull() | ~col.rlike(r"[^\s\p{Z}]")


def squeeze(col: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(col, SPACE, " "))


def truncate(col: Column, length: int = 500) -> Column:
    return F.substring(col, 1, length)


def preview(col: Column, length: int = 60) -> Column:
    return F.when(F.length(col) > length, F.concat(F.substring(col, 1, length), F.lit("..."))).otherwise(col)


# attributes, in which a quoted value may hold any character
_INSIDE = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
# what is no text, left to right: comments, scripts and styles (to the end if unclosed), tags, tags with an open quote
_MARKUP = (
    rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b{_INSIDE}>.*?(?:</\1\s*>|\z)|</?[a-z!?]{_INSIDE}>|</?[a-z!?][^>]*>"
)


def html_to_text(html: Column) -> Column:
    """Text of an HTML page: no comments, scripts, styles or tags; entities decoded once."""
    return squeeze(decode_entities(F.regexp_replace(html, _MARKUP, "")))


def decode_entities(text: Column) -> Column:
    """Replace numeric and named entities.

    Only the entities a text holds are looked up, each once. Those that stand
    for an ampersand go last, so that nothing is decoded twice.
    """
    found = F.array_distinct(
        F.regexp_extract_all(text, F.lit(r"(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z][a-zA-Z0-9]*;)"), F.lit(1))
    )
    table = F.from_json(F.lit(json.dumps(_ENTITIES)), "map<string,string>")
    ampersand = r"^&(amp|#0*38|#[xX]0*26);$"

    def decoded(entity: Column) -> Column:
        code = (
            F.when(entity.rlike("^&#[0-9]"), F.regexp_extract(entity, "([0-9]+)", 1).try_cast("bigint"))
            .when(entity.rlike("^&#[xX]"), F.conv(F.regexp_extract(entity, "[xX]([0-9a-fA-F]+)", 1), 16, 10).cast("bigint"))
        )
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, char).otherwise(F.coalesce(F.try_element_at(table, entity), entity))

    others = F.filter(found, lambda e: ~e.rlike(ampersand))
    text = F.aggregate(others, text, lambda acc, e: F.replace(acc, e, decoded(e)))
    return F.regexp_replace(text, ampersand.strip("^$"), "&")


def contains_word(text: Column, words: list[str]) -> Column:
    """Any of ``words`` as a whole word, whatever the script; ``text`` in lower case.

    Most texts are settled by a plain substring search. The pattern starts with
    the word itself and looks at its neighbours only where the word was found.
    """
    hit = F.lit(False)
    for word in words:
        w = re.escape(word.lower())
        hit = hit | (text.contains(word.lower()) & text.rlike(f"{w}(?![{WORD}])(?<![{WORD}]{w})"))
    return hit


def contains_any(text: Column, terms: list[str]) -> Column:
    """Any of ``terms`` as a substring; ``text`` in lower case."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | text.contains(term.lower())
    return hit


def words(col: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"([{WORD}]{{2,}})"), F.lit(1))


def ngrams(col: Column) -> Column:
    """Words and pairs of neighbouring words, repeats included."""

    def with_pairs(w: Column) -> Column:
        pairs = F.zip_with(
            F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, 2, F.size(w)),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        return F.concat(w, pairs)

    return let(words(col), with_pairs)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A column that a lambda refers to may be computed again for every element
    once the optimizer has merged projections; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns so that they are computed once per row.

    Filters and generators on a plain projection are pushed below it and
    compute its expressions again; they are not pushed through ``inline_outer``.
    """
    row = F.struct(*[col.alias(name) for name, col in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(row)))
