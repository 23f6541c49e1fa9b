"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Within its source every document has an exponential key scaled by its quality
weight. Whole epochs come first; the rest of a source's target is filled in key
order. What that takes is a prefix, so a source's cutoff key decides for each of
its documents in place, and texts are never moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm import words as W
from newsflow.llm.tables import keep, rest
from newsflow.operators.ordered import number_rows, running_totals

NEW = ("size", "source_size", "target", "taken")
BROADCAST_SOURCES = 50_000  # rows of six numbers and a name


def quality_weight() -> Column:
    """1 for a text without symbols, down to 0.1 for one with a tenth of them or more."""
    text = W.text_of("text")
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(10.0) * W.n_symbols(text) / F.greatest(F.char_length(text), F.lit(1)))


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 0,
    weight: Column | None = None,
) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` with ``size``, ``source_size``, ``target`` and ``taken`` words.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source's words, and
    the excess goes to the others by weight. A document is taken as often as its
    source's target holds whole epochs, and once more if it lies in the rest of the
    target: keys -ln(u) / weight in ascending order, a document counted as in while
    its middle is. ``u`` comes from ``doc_id`` and ``seed`` alone, so reruns agree.

    A null text has size 0 and is taken 0 times its size. Rows that share a ``doc_id``
    in a source have one place in its order and are taken alike. Columns named as in
    ``NEW`` are replaced; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    size, key = W.n_words(W.text_of("text")), sampling_key(quality_weight() if weight is None else weight, seed)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    named = docs.select(
        F.struct(*rest(docs, *NEW)).alias("row"), F.col(f"`{source}`").alias("source"), size.alias("size"), key.alias("key"), place.alias("place")
    )
    sizes = keep(named.select("source", "size", "key", "place"), "sizes")
    targets = source_targets(sizes, weights, share, cap)
    ordered = running_totals(sizes, F.asc_nulls_last("source"), "key", "place", totals={"upto": "size"})
    same = F.col("o.source").eqNullSafe(F.col("t.source"))
    inside = F.col("o.upto") - F.col("t.start") - F.col("o.size") / 2 <= F.col("t.rest")
    cutoff = (
        ordered.alias("o")
        .join(_small(targets).alias("t"), same)
        .where(inside & (F.col("t.rest") > 0))
        .groupBy("o.source")
        .agg(F.max(F.struct("o.key", "o.place")).alias("cutoff"))
    )
    plan = targets.alias("t").join(cutoff.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    plan = keep(plan.select(F.col("t.source").alias("to"), "source_size", "target", "epochs", "cutoff"), "mix")
    again = F.coalesce(F.struct("key", "place") <= F.col("cutoff"), F.lit(False))
    taken = F.col("size") * (F.col("epochs") + again.cast("long"))
    mixed = named.join(_small(plan), F.col("source").eqNullSafe(F.col("to")), "left")
    return mixed.select("row.*", "size", "source_size", "target", taken.alias("taken"))


def sampling_key(weight: Column, seed: int) -> Column:
    """-ln(u) / weight, with u in (0, 1) from the document's id and the seed."""
    code = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    u = (F.conv(F.substring(code, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Per source: its words, target, whole epochs, the rest of the target, and the words of the sources before.

    Sorted by cap / weight, capped sources come first. What is left for each
    unit of weight is largest at the first source that is not capped.
    """
    own = keep(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    own = number_rows(own, F.asc_nulls_last("source"), name="nth")
    weighed = own.withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.pmod(F.col("nth") - 1, F.lit(len(weights))).cast("int")])
    weighed = weighed.withColumns({"cap": F.lit(float(cap)) * F.col("source_size")})
    weighed = running_totals(keep(weighed, "weighed"), "nth", totals={"sum_size": "source_size"})
    weighed = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = keep(running_totals(keep(weighed, "ratios"), "ratio", "nth", totals={"sum_cap": "cap", "sum_weight": "weight"}), "filled")
    whole = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weight = share * (whole[0] or 0), whole[1] or 0.0
    left = (F.lit(budget) - (F.col("sum_cap") - F.col("cap"))) / (F.lit(all_weight) - (F.col("sum_weight") - F.col("weight")))
    level = filled.agg(F.max(left)).first()[0] or 0.0
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    epochs = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return keep(
        filled.select(
            "source",
            "source_size",
            target.alias("target"),
            epochs.alias("epochs"),
            (target - epochs * F.col("source_size")).alias("rest"),
            (F.col("sum_size") - F.col("source_size")).alias("start"),
        ),
        "targets",
    )


def _small(table: DataFrame) -> DataFrame:
    """A written table of sources, broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else table
