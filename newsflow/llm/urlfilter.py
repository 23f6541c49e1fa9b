"""URL rules and lists: a blocked Bloom filter before an exact hash join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm import words as W
from newsflow.llm.tables import keep, rest

WORDS = 8  # a block has 8 longs, 512 bits; a url sets one bit in each
BITS_PER_URL, MOST_BLOCKS = 12, 1 << 17  # 8 MiB of bits at most, so the filter can always be broadcast
NEW = ("host", "path", "rule", "verdict")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return W.ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a page's address: no ``www.``, no slashes at the end, no scheme, query or fragment."""
    return F.concat(F.regexp_replace(host, "^www\\.", ""), F.regexp_replace(path, "/+$", ""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule ``(host, path, verdict)``, null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def bloom_blocks(listed: DataFrame) -> tuple[DataFrame, int]:
    """``listed(address)`` as ``(block, words)``: the bits of each block, and how many blocks there are."""
    count = listed.count()
    blocks = min(MOST_BLOCKS, max(1, math.ceil(count * BITS_PER_URL / (64 * WORDS))))
    bits = listed.select(_block(F.col("address"), blocks).alias("block"), *_masks(F.col("address")))
    merged = bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    return merged, blocks


def _block(address: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(address), F.lit(blocks)).cast("int")


def _masks(address: Column) -> list[Column]:
    """The bits of an address: one in each word of its block."""
    code = F.xxhash64(address, F.lit(1))
    places = [F.shiftrightunsigned(code, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place).alias(f"w{i}") for i, place in enumerate(places)]


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``pages(url, ...)`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest rule that fits the host or a parent of it and begins the path says
    ``allow`` or ``block``. Without a rule, a page is blocked if its canonical address is
    among those of ``listed(url)``, else allowed. A blocked Bloom filter of at most
    8 MiB passes possible hits on; only those meet the list in an exact join.

    A null url, or one without ``://``, has an empty host and path, and an empty address is
    never listed. Null and repeated listed urls do no harm; repeated pages are judged
    alike. Columns named as in ``NEW`` are replaced.
    """
    listed = keep(listed.select(canonical(*split_url(F.col("url"))).alias("address")).where("address <> ''").distinct(), "listed")
    blooms, blocks = bloom_blocks(listed)
    host, path = split_url(F.col("url"))
    rows = pages.select(F.struct(*rest(pages, *NEW)).alias("row"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    address = canonical(F.col("host"), F.col("path"))
    rows = rows.withColumn("address", F.when(F.col("said").isNull() & (address != ""), address))
    rows = rows.withColumns({"at": _block(F.col("address"), blocks)} | {f"m{i}": m for i, m in enumerate(_masks(F.col("address")))})
    rows = rows.join(F.broadcast(blooms), F.col("at") == F.col("block"), "left")
    hit = F.col("address").isNotNull() & F.col("w0").isNotNull()
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    rows = rows.select("row", "host", "path", "rule", "said", F.when(hit, F.col("address")).alias("address"))
    # a null key would gather in one task: only possible hits are dealt by address
    sure = rows.where(F.col("address").isNull()).select("row", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"))
    maybe = rows.where(F.col("address").isNotNull()).join(listed.withColumn("known", F.lit(True)), "address", "left")
    maybe = maybe.select("row", "host", "path", "rule", F.when(F.col("known"), "block").otherwise("allow").alias("verdict"))
    return sure.union(maybe).select("row.*", *NEW)
