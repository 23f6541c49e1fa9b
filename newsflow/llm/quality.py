"""Quality rules: counts in a text, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm import words as W
from newsflow.llm.tables import keep, rest

BROADCAST_LINES = 200_000  # at most so many common lines (8 bytes each) are broadcast
HOST_LINES = 1_000  # a host's common lines are looked up as one list up to this size, else met line by line
NEW = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "clean_text", "kept")


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    least_words: int = 50,
    repeat_percent: int = 50,
    common_docs: int = 10,
    common_percent: int = 10,
    left_percent: int = 30,
    enough_docs: int | None = None,
) -> DataFrame:
    """``docs(doc_id, text, host, ...)`` with the counts, the verdict ``kept`` and ``clean_text``.

    A line is common if more than ``common_docs`` and more than ``common_percent`` %
    of the distinct documents of its host have it. With ``enough_docs``, a line that more
    distinct documents of its host have is common whatever its share: that limit does
    not grow with the host. Lines are compared normalised:
    trimmed, A-Z lower-cased, digits as 0, white space as one space; copies of a
    whole text are one document. Common lines are removed (``clean_text``), and a
    document that keeps less than ``left_percent`` % of its words is rejected, as is
    one that fails the base rules: fewer than ``least_words`` words, or more than
    ``repeat_percent`` % of them in repeated 3-word windows.

    A null text counts as empty, a null host as a host of its own. ``NEW`` names the
    added columns; columns of these names are replaced. Repeated rows are judged
    alike. An empty table gives an empty table.
    """
    common = common_lines(docs, host, common_docs, common_percent, enough_docs)
    text = W.text_of("text")
    other = rest(docs, *NEW)
    rows = docs.select(F.struct(*other).alias("row"), text.alias("_text"), F.col(f"`{host}`").alias("_host"))
    sizes = common.groupBy("host").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("all"), F.coalesce(F.max("count"), F.lit(0)).alias("most"))
    size = sizes.first()
    if size["most"] <= HOST_LINES:
        hosts = common.groupBy("host").agg(F.collect_set("line").alias("_common"))
        hosts = F.broadcast(hosts) if size["all"] <= BROADCAST_LINES else hosts
        rows = rows.join(hosts, F.col("_host").eqNullSafe(F.col("host")), "left")
        pure = ~F.coalesce(F.size("_common") > 0, F.lit(False))
        clean = F.filter(W.lines(F.col("_text")), lambda x: ~F.array_contains("_common", line_hash(x)))
    else:
        common = F.broadcast(common) if size["all"] <= BROADCAST_LINES else common
        rows = _with_common_places(rows, common)
        pure = F.col("_gone").isNull()
        clean = W.without_lines(W.lines(F.col("_text")), F.col("_gone"))
    clean = F.when(pure, F.col("_text")).otherwise(F.array_join(clean, "\n"))
    rows = rows.select("row", "_text", clean.alias("clean_text"), pure.alias("_pure"))
    rows = with_base_counts(rows)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    gone = F.when(F.col("_pure"), F.lit(0).cast("long")).otherwise(F.col("n_words") - W.n_words(F.col("clean_text")))
    rows = rows.withColumns({"base_failed": failed, "n_common_words": gone})
    depleted = 100 * (F.col("n_words") - F.col("n_common_words")) < left_percent * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted).select("row.*", *NEW)


def line_hash(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(W.ascii_lower(line), "[0-9]", "0"), "[\\x20\\x09-\\x0D]+", " ")
    return F.xxhash64(F.trim(plain))


def _with_common_places(rows: DataFrame, common: DataFrame) -> DataFrame:
    """``rows(_text, _host, ...)`` with ``_gone``: the sorted places of common lines, null if there are none."""
    rows = rows.withColumn("_hash", F.md5(F.col("_text").cast("binary")))
    placed = F.transform(W.lines(F.col("_text")), lambda x, i: F.struct(i.alias("place"), W.has_word(x).alias("word"), line_hash(x).alias("line")))
    lines = rows.select("_host", "_hash", F.inline(F.filter(placed, lambda x: x["word"])))
    met = lines.alias("l").join(common.alias("c"), (F.col("l.line") == F.col("c.line")) & F.col("l._host").eqNullSafe(F.col("c.host")))
    gone = met.groupBy("l._host", "l._hash").agg(F.sort_array(F.collect_set("l.place")).alias("_gone"))
    on = F.col("r._host").eqNullSafe(F.col("g._host")) & (F.col("r._hash") == F.col("g._hash"))
    return rows.alias("r").join(gone.alias("g"), on, "left").select("r.row", "r._text", "g._gone")


def common_lines(docs: DataFrame, host: str, common_docs: int, common_percent: int, enough_docs: int | None = None) -> DataFrame:
    """``(host, line)``: hashes of the lines above the limits, with words in them."""
    held = docs.select(F.col(f"`{host}`").alias("host"), W.text_of("text").alias("text"))
    held = held.select("host", F.xxhash64("text").alias("doc"), W.lines(F.col("text")).alias("lines"))
    own = F.array_distinct(F.transform(F.filter("lines", W.has_word), line_hash))
    lines = held.select("host", "doc", F.explode(own).alias("line"))
    # distinct in two steps: a line in a third of all documents is spread over all tasks first
    seen = lines.groupBy("host", "line").agg(F.countDistinct("doc").alias("docs")).where(F.col("docs") > common_docs)
    total = held.groupBy("host").agg(F.countDistinct("doc").alias("total"))
    seen = keep(seen, "lines")
    above = seen.alias("s").join(total.alias("t"), F.col("s.host").eqNullSafe(F.col("t.host")))
    enough = F.lit(False) if enough_docs is None else F.col("docs") > enough_docs
    above = above.where((100 * F.col("docs") > common_percent * F.col("total")) | enough)
    return keep(above.select(F.col("s.host").alias("host"), "line"), "common")


def with_base_counts(rows: DataFrame) -> DataFrame:
    """``rows(_text, ...)`` with the counts of the base rules.

    Repeated windows: hashes are packed with their places, as many bits as those need,
    and sorted, so that equal ones are neighbours; neighbours are compared by their
    whole hashes. Each place then covers three words, or those up to the next place.
    Every step is linear but for the two sorts, and each is a column of its own, so
    that none is computed twice.
    """
    text = F.col("_text")
    rows = rows.withColumns({"_words": W.words(text), "_lines": F.filter(W.lines(text), W.has_word)})
    firsts = F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0)))
    rows = rows.withColumn("_hashes", F.transform(firsts, lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))))
    bits = F.length(F.bin(F.size("_hashes")))
    rows = rows.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    packed = F.transform("_hashes", lambda x, i: x - x.bitwiseAND(F.col("_mask")) + i)
    rows = rows.withColumn("_packed", F.sort_array(packed))

    def same(x: Column, other: Column) -> Column:
        mask = F.col("_mask")
        place = lambda v: v.bitwiseAND(mask).cast("int")
        return (x - x.bitwiseAND(mask) == other - other.bitwiseAND(mask)) & (F.get("_hashes", place(x)) == F.get("_hashes", place(other)))

    again = F.filter("_packed", lambda x, i: same(x, F.get("_packed", i + 1)) | same(x, F.get("_packed", i - 1)))
    rows = rows.withColumn("_again", F.sort_array(F.transform(again, lambda x: x.bitwiseAND(F.col("_mask")))))
    covers = F.transform("_again", lambda x, i: F.least(F.coalesce(F.get("_again", i + 1) - x, F.lit(3)), F.lit(3)))
    return rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": W.n_symbols(text),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.aggregate(covers, F.lit(0).cast("long"), lambda s, n: s + n),
        }
    )
