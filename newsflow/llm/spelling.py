"""Spelling variants: words one edit apart, found by walking a trie level by level.

The trie is a table of edges, once over the words and once over the reversed
words. A word enters it where its first (reversed: last) half ends and edits one
of the positions after that; the other positions belong to the other trie. Its
states (word, position, node, edit) are joined with the edges: the first step deletes
or replaces a letter and follows the next one, each further step follows one letter. A
state that ends on a word has found a neighbour. Insertions are the deletions of the
longer word, and a replacement is walked from the smaller letter only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import forget, keep, shuffles_dropped
from newsflow.llm.texthash import mix
from newsflow.llm.words import ascii_lower, text_of

LETTERS = "A-Za-zÀ-ÿ"
DAMAGE = 31  # one in so many occurrences loses a letter
LONGEST = 64  # letters of the longest word in the trie; see :func:`_long_pairs`
_END = "$"  # ends a word in the trie; no letter


def damaged_words(docs: DataFrame, least: int = 7) -> DataFrame:
    """``word``: each run of letters of at least ``least`` code points, A-Z lower-cased.

    Let h be the crc32 of ``<doc_id>:<run>``; where ``DAMAGE`` divides it, the run's code
    point h % length is gone. Shorter results are left out. A row without an
    id loses no letter; a null text has no words.
    """
    runs = F.regexp_extract_all(text_of("text"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", ascii_lower(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % DAMAGE == 0, shorter).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.char_length("word") >= least)


def spelling_variants(docs: DataFrame, least: int = 7, least_n: int = 2, times: int = 10) -> DataFrame:
    """Words of :func:`damaged_words` with at least ``least_n`` occurrences, each with its form.

    Two words are near if one inserted, deleted or replaced code point separates
    them. ``form`` is the near word of the largest ``n`` (ties: the first in code-point order) if that is at
    least ``times`` the word's own, else null; ``root`` is where following forms ends, the word itself
    without one. Also ``n_near`` and ``form_n``. Empty tables give an empty
    table; other columns are not looked at.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        words = keep(damaged_words(docs, least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n), "words")
        found = keep(near_pairs(words), "near")
        best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
        near = found.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        rows = words.join(near, "word", "left")
        form_n = -F.col("best.n")
        fits = form_n >= times * F.col("n")
        rows = rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.word")).alias("form"), F.when(fits, form_n).alias("form_n")
        )
        rows = keep(rows, "formed")
        forget(found, words)
        roots = _roots(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
        rows = rows.join(roots, "word", "left")
        return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for all words of a table ``(word, n)`` of at least 6 code points each, both ways round."""
    size = F.char_length("word")
    found = _trie_pairs(words.where(size <= LONGEST)).union(_long_pairs(words.where(size >= LONGEST)))
    # the join with the words drops what only equal hashes made
    here = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_way = keep(found.distinct().join(here, "near").select("word", "n", "near", "near_n"), "pairs")
    return one_way.select("word", "near", "near_n").union(one_way.select("near", "word", "n"))


def _node(path: Column) -> Column:
    return F.xxhash64("side", path)


def _letter(at: Column) -> Column:
    return F.substring("letters", at, F.lit(1))


def _sides(words: DataFrame) -> DataFrame:
    """Each word as a path of either trie, with the place where its states start."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    forward = F.struct(F.lit(0).alias("side"), F.concat("word", F.lit(_END)).alias("letters"), half.alias("start"))
    back = F.struct(F.lit(1).alias("side"), F.concat(F.reverse("word"), F.lit(_END)).alias("letters"), (size - half).alias("start"))
    return words.select("word", "n", size.alias("size"), F.inline(F.array(forward, back)))


def _edges(words: DataFrame) -> DataFrame:
    """``node, letter, next, depth`` of both tries; ``skipped`` is set where ``next`` is a grandchild.

    States start at depth 3 at least, so edges above that are left out.
    """
    depth = F.col("depth")
    paths = _sides(words).select("side", F.explode(F.sequence(F.lit(4), F.col("size") + 1)).alias("depth"), "letters")
    paths = paths.select("side", "depth", F.substring("letters", F.lit(1), depth).alias("letters")).distinct()
    child = F.struct(_node(F.substring("letters", F.lit(1), depth - 1)).alias("node"), F.lit(None).cast("string").alias("skipped"))
    grandchild = F.struct(_node(F.substring("letters", F.lit(1), depth - 2)).alias("node"), _letter(depth - 1).alias("skipped"))
    from_ = F.when(depth > 4, F.array(child, grandchild)).otherwise(F.array(child))
    return paths.select(_letter(depth).alias("letter"), _node(F.col("letters")).alias("next"), "depth", F.inline(from_))


def _trie_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near``: each pair found from its longer word, or from the one with the smaller letter."""
    edges = keep(_edges(words), "edges")
    place = F.col("place")  # letters before the edited one
    starts = _sides(words).select("*", F.explode(F.sequence(F.col("start"), F.col("size") - 1)).alias("place"))
    own, before, after = _letter(place + 1), _letter(place), _letter(place + 2)
    first_of_run = own != F.when(F.col("side") == 0, before).otherwise(after)  # equal letters: one deletion is enough
    asked = starts.select(
        "word", "n", "side", "place", _node(F.substring("letters", F.lit(1), place)).alias("node"), own.alias("own"), after.alias("letter"), first_of_run.alias("deletes")
    )
    edits = F.when(F.col("skipped").isNull(), F.col("deletes")).otherwise(F.col("skipped") > F.col("own"))
    states = asked.join(edges, ["node", "letter"]).where(edits)
    states = keep(states.select("word", "n", "side", "place", "skipped", (place + 3).alias("at"), F.col("next").alias("node")), "states")
    ended, level = [], 4
    while True:
        ended.append(states.where(F.col("at") > F.char_length("word") + 1))
        moving = states.where(F.col("at") <= F.char_length("word") + 1)
        if moving.isEmpty():
            break
        level += 1  # states have left the levels above, and so can the edges
        read = F.concat(F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")), F.lit(_END))
        moving = moving.withColumn("letter", F.substring(read, F.col("at"), F.lit(1)))
        below = edges.where(F.col("skipped").isNull() & (F.col("depth") >= level)).select("node", "letter", "next")
        moved = moving.join(below, ["node", "letter"])
        states = keep(moved.select("word", "n", "side", "place", "skipped", (F.col("at") + 1).alias("at"), F.col("next").alias("node")), "states")
    done = ended[0]
    for more in ended[1:]:
        done = done.union(more)
    at = F.when(F.col("side") == 0, place).otherwise(F.char_length("word") - 1 - place)
    put = F.coalesce("skipped", F.lit(""))
    near = F.concat(F.substring("word", F.lit(1), at), put, F.substring("word", at + 2, F.char_length("word")))
    return done.select("word", "n", near.alias("near"))


def _long_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near`` for pairs of words of ``LONGEST`` code points and more.

    A walk would take as many levels as they have letters. Each word offers the hash of itself
    and of itself without each letter, so that the rows grow with the letters; near words meet
    at one of them, and are then compared letter by letter.
    """
    offered = words.select("word").mapInArrow(_variants, "digest string, place int, hash long")
    offered = keep(offered, "long")
    whole = offered.where("place < 0").select(F.col("digest").alias("other"), "hash")
    left = offered.where("place >= 0")
    deleted = left.join(whole, "hash").select("digest", "other")
    replaced = left.join(left.withColumnRenamed("digest", "other"), ["hash", "place"]).where("digest < other").select("digest", "other")
    texts = words.select(F.md5(F.col("word").cast("binary")).alias("digest"), "word", "n")
    pairs = deleted.union(replaced).distinct().join(texts, "digest")
    pairs = pairs.join(texts.select(F.col("digest").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")), "other")
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    # told as the trie does, since it also has the pairs of LONGEST letters
    size, near_size = F.char_length("word"), F.char_length("near")
    first = (size > near_size) | ((size == near_size) & (F.col("word") < F.col("near")))
    one, other = F.struct("word", "n", "near"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"))
    return pairs.select(F.when(first, one).otherwise(other).alias("pair")).select("pair.*")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factor = 0x9E3779B97F4A7C15
    back = np.uint64(pow(factor, -1, 1 << 64))
    for batch in batches:
        for word in batch.column(0).to_pylist():
            letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            n = len(letters)
            powers = np.full(n, factor, np.uint64)
            powers[0] = 1
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(letters) * np.multiply.accumulate(powers), out=sums[1:])
            without = sums[:n] + (sums[n] - sums[1:]) * back  # letters after the gap move one place down
            yield pa.record_batch(
                {
                    "digest": pa.repeat(hashlib.md5(word.encode()).hexdigest(), n + 1),
                    "place": np.arange(-1, n, dtype=np.int32),
                    "hash": np.concatenate([sums[n:], without]).view(np.int64),
                }
            )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, root`` of one step. Forms have ever more occurrences, so chains are short and end."""
    roots = keep(forms, "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = keep(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        ends = moved.where("moved").isEmpty()
        forget(roots)
        roots = moved.select("word", "root")
        roots.kept_at = moved.kept_at
        if ends:
            return roots
