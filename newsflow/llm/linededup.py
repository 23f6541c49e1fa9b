"""Line dedup by content-defined chunks, in DataFrame functions only.

A rolling hash over each line with words and the one before it has one of two phases. Every line starts a
chunk for each phase, which ends with the next line of that phase: boundaries depend on the lines of the
chunk alone, so text that moves keeps its chunks. As a line has one phase or the other, two
neighbouring lines are always a chunk, and no repeated passage falls between boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm import words as W
from newsflow.llm.tables import keep, rest

FACTOR, MODULUS = 1_000_003, 2_147_483_647
MOST_LINES = 8  # of a chunk
NEW = ("n_lines", "n_removed_lines", "n_chunks", "n_removed_chunks", "clean_text")


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``clean_text``: chunks of two lines or more met before are removed.

    Lines without words stand in no chunk, but those inside a chunk go with it. Of equal chunks
    that of the smallest ``doc_id`` (null last), then of the text smaller as hash, then the first
    in its text stays; lines are removed by the union of their chunks. So every line of a repeated
    passage goes, wherever it stands, and the first copy of each line of the table stays. Repeated chunks are
    found by their SHA-256 and then compared as bytes; unlike bytes of one digest stop the job. ``n_lines``,
    ``n_chunks`` and the removed ones are counted.

    A null text counts as empty (one empty line). Rows equal in ``doc_id`` and text
    count as one and get the same result. Columns named as in ``NEW`` are replaced;
    an empty table gives an empty table.
    """
    keyed = docs.select("doc_id", W.text_of("text").alias("_text"))
    chunked = _chunks(keyed.select(*_key("_text"), W.lines(F.col("_text")).alias("_lines")))
    # not the bare column: Spark would infer a filter on its size, push it down and chunk each text once per line
    listed = F.inline(F.filter("_chunks", lambda x: x["place"] >= 0))
    chunks = keep(chunked.select("id", "hash", listed), "chunks")  # narrow: no text
    at = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "place", "upto")
    met = chunks.groupBy("code").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
    found = keep(met.select("code", "first"), "repeated")
    again = chunks.alias("p").join(found.alias("f"), F.col("p.code") == F.col("f.code"))
    own = F.struct(F.col("p.id").isNull().alias("none"), "p.id", "p.hash", "p.place", "p.upto")
    again = again.select("p.id", "p.hash", "p.place", "p.upto", "p.code", (own != F.col("f.first")).alias("gone"))
    spans = again.groupBy("id", "hash").agg(F.collect_set(F.struct("place", "upto", "code", "gone")).alias("_spans"))
    spans = keep(spans, "spans")
    counts = chunks.groupBy("id", "hash").agg(F.countDistinct("place", "upto").alias("_n_chunks"))

    other = rest(docs, *NEW)
    held = docs.select(F.struct(*other).alias("row"), W.text_of("text").alias("_text"), "doc_id").select("row", "_text", *_key("_text"))
    _compare_bytes(held.alias("h").join(spans.alias("s"), _same("h", "s")).select("_text", "_spans"))
    gone = F.filter("_spans", lambda x: x["gone"])
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(gone, lambda x: F.sequence(x["place"], x["upto"])))))
    marks = _beside(counts, spans).select("id", "hash", "_n_chunks", F.when(F.size(gone) > 0, places).alias("_gone"), F.size(gone).cast("long").alias("_n_gone"))
    rows = held.alias("h").join(marks.alias("g"), _same("h", "g"), "left").select("row", "_text", "_n_chunks", "_gone", "_n_gone")
    left = F.array_join(W.without_lines(W.lines(F.col("_text")), F.col("_gone")), "\n")
    rows = rows.withColumns(
        {
            "n_lines": _n_lines(F.col("_text")),
            "n_removed_lines": F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long"),
            "n_chunks": F.coalesce("_n_chunks", F.lit(0).cast("long")),
            "n_removed_chunks": F.when(F.col("_gone").isNull(), F.lit(0).cast("long")).otherwise(F.col("_n_gone")),
            "clean_text": F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(left),
        }
    )
    return rows.select("row.*", *NEW)


def _chunks(lines: DataFrame) -> DataFrame:
    """``lines(_lines, ...)`` with ``_chunks``: first and last place and SHA-256 of each; every step is a column of its own."""
    placed = F.transform("_lines", lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    rows = lines.withColumn("_worded", F.filter(placed, lambda x: W.has_word(x["line"])))
    rows = rows.withColumn("_codes", F.transform("_worded", lambda x: line_code(x["line"])))
    rows = rows.withColumn("_n", F.size("_worded"))
    later = F.slice("_codes", 2, F.greatest(F.col("_n") - 1, F.lit(0)))
    rolled = F.transform(later, lambda c, i: ((F.get("_codes", i) * FACTOR + c) % MODULUS % 2).cast("int"))
    rows = rows.withColumn("_phases", rolled)  # of the lines from the second on
    # the phase of the line after a chunk's first one ends its short chunk; the other phase ends further on
    further = F.transform("_phases", lambda p, i: F.array_position(F.slice("_phases", i + 2, MOST_LINES - 2), 1 - p).cast("int"))
    rows = rows.withColumn("_further", further)
    last = lambda x, i: F.when(x > 0, i + 1 + x).otherwise(F.least(i + MOST_LINES - 1, F.col("_n") - 1))
    ends = F.transform("_further", lambda x, i: F.array(i + 1, last(x, i)))
    pairs = F.transform(ends, lambda e, i: F.transform(F.array_distinct(e), lambda j: F.struct(i.alias("i"), j.alias("j"))))
    rows = rows.withColumn("_pairs", F.flatten(pairs))

    def chunk(x: Column) -> Column:
        text = F.array_join(F.transform(F.slice("_worded", x["i"] + 1, x["j"] - x["i"] + 1), lambda w: w["line"]), "\n")
        place = lambda n: F.get("_worded", x[n])["at"]
        return F.struct(place("i").alias("place"), place("j").alias("upto"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("code"))

    return rows.withColumn("_chunks", F.transform("_pairs", chunk))


def _compare_bytes(rows: DataFrame) -> None:
    """Stop if repeated chunks of one digest differ: of each digest the smallest and the largest text are compared."""
    rows = rows.withColumn("_lines", W.lines(F.col("_text")))
    inside = lambda x: F.filter(F.slice("_lines", x["place"] + 1, x["upto"] - x["place"] + 1), W.has_word)
    texts = F.transform("_spans", lambda x: F.struct(x["code"].alias("code"), F.array_join(inside(x), "\n").alias("text")))
    texts = rows.select(F.inline(texts))
    unlike = texts.groupBy("code").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b")
    if not unlike.isEmpty():
        raise ValueError("chunks with one digest differ")


def _beside(counts: DataFrame, spans: DataFrame) -> DataFrame:
    on = _same("c", "s")
    return counts.alias("c").join(spans.alias("s"), on, "left").select("c.id", "c.hash", "_n_chunks", "_spans")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.hash") == F.col(f"{b}.hash"))


def _key(text: str) -> list[Column]:
    return [F.col("doc_id").alias("id"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("hash")]


def _n_lines(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long")


def line_code(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")
