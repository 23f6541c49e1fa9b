"""Exact removal of repeated byte strings by a difference cover, one bucket block at a time.

A difference cover D of period v holds, for any two positions p and q, a shift
below v that moves both onto positions of D. So if the ``width`` bytes at p and q
are equal, two *cover samples* inside them are equal for at least
``width - v + 1`` bytes. Only samples (14 % of the positions) are ranked:

1. Samples fall into suffix buckets by the hash of those bytes. One block of
   buckets is sorted at a time, so that disk and memory hold one block.
2. Samples with equal *contexts* (all bytes of the windows they can anchor) are
   tied over their whole length: every window of a later one is a repeat.
3. Samples that agree in the bytes of their bucket but not in the context are
   short ties. For the first sample of each such context the windows themselves
   are ranked, again in buckets.

Only equality matters here, so ranks are 64-bit hashes (two of them where they
decide), not lexicographic ranks. A task sends one row group per bucket, holding
one record per distinct sample, so a passage in a third of all texts costs a
bucket one record per task, never one per text.

Buckets grow with the table, so a task gathers about a million records before it
deals them out, and deals, reads and joins all row groups at once: work follows
the records, not the row groups, whose number is that of buckets times tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import keep, rest, shuffles_dropped, small_batches
from newsflow.llm.texthash import WindowHash, chunks, utf8

#: A perfect difference set: every difference modulo 57 comes from one pair of its members.
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
WIDEST = 256  # polynomial hashes modulo 2^64 stay apart for windows this short
LAST_ID = (1 << 63) - 1  # orders rows without an id after all others

PARTS = "kind int, bucket int, ids binary, hashes binary, doc binary, a binary, b binary, c binary"
SAMPLE, SPAN, ASK, WINDOW = 0, 1, 2, 3
_SAMPLES_AT_ONCE = 1_000_000  # or windows; physical only
_BATCH_BYTES = 4_000_000  # of row groups that travel together; physical only
_PIECE = 200_000  # bytes hashed in one go, which caches hold; physical only
_BUCKET_SAMPLES, _BUCKET_BYTES = 500_000, 16_000_000  # of a suffix bucket in one block, of the texts whose spans are joined together


def remove_repeats(docs: DataFrame, width: int = 100, blocks: int = 4) -> DataFrame:
    """``docs(doc_id, text, ...)`` with the bytes left after removing repeats.

    Adds ``n_bytes``, ``removed`` (maximal removed runs as [start, end) bytes) and
    ``kept`` (the remaining bytes). A byte goes if some ``width`` bytes around it
    also start earlier: in a smaller ``doc_id``, or earlier in the same text.

    Null texts count as empty; rows without ``doc_id`` come last. Rows that share
    a ``doc_id`` are ordered by the hash of their text; rows equal in both count
    as one, and get the same result. Other columns are kept; ``n_bytes``,
    ``removed`` and ``kept`` replace columns of these names. An empty table gives
    an empty table. A text is held in one task, at about 40 times its size.
    """
    if not PERIOD <= width <= WIDEST:
        raise ValueError(f"width must be {PERIOD} to {WIDEST}")
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64("text").alias("hash"),
        F.col("text").cast("string").alias("text"),
    )
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # both follow the bytes alone, so that a table makes the same rows under any settings
    buckets = max(1, math.ceil(n_bytes * len(COVER) / PERIOD / blocks / _BUCKET_SAMPLES))
    doc_buckets = max(1, math.ceil(n_bytes / _BUCKET_BYTES))
    grouped = "id long, hash long, a binary, b binary"

    with shuffles_dropped(spark):
        found = None
        for block in range(blocks):
            rows = texts.mapInArrow(_samples(width, block, blocks, buckets, doc_buckets), PARTS)
            decided = rows.groupBy("kind", "bucket").applyInArrow(_decide(width, doc_buckets), PARTS)
            kept = keep(decided, "ties")
            found = kept if found is None else found.union(kept)
        asked = found.where(F.col("kind") == ASK).groupBy("kind", "bucket").applyInArrow(_by_text, grouped)
        asked = asked.select("id", "hash", F.col("a").alias("asked"))
        asked_texts = keep(texts.join(asked, ["id", "hash"]), "asked")
        found = found.where(F.col("kind") == SPAN)
        # windows are fewer than samples: half as many blocks, so that the asked texts are hashed half as often
        for block in range(max(1, blocks // 2)):
            rows = asked_texts.mapInArrow(_windows(width, block, max(1, blocks // 2), 2 * buckets, doc_buckets), PARTS)
            decided = rows.groupBy("kind", "bucket").applyInArrow(_decide(width, doc_buckets), PARTS)
            found = found.union(keep(decided, "windows"))
        spans = found.groupBy("kind", "bucket").applyInArrow(_by_text, grouped)
        spans = keep(spans.select("id", "hash", F.col("a").alias("from"), F.col("b").alias("to")), "spans")

    new = ("n_bytes", "removed", "kept")
    keys = [texts_key.alias(n) for n, texts_key in zip(("id", "hash"), _keys(), strict=True)]
    other = rest(docs, *new)
    held = docs.select(F.struct(*other).alias("row"), *keys)
    joined = held.join(spans, ["id", "hash"], "left").select("row", "from", "to")
    schema = f"row {held.schema['row'].dataType.simpleString()}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(_cut_out, schema).select("row.*", *new)


def _keys():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), F.xxhash64("text")


# -- inside tasks ----------------------------------------------------------------------------


def _cells(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary cell for the values between each edge and the next; the first edge is 0."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _flat(column: pa.Array | pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all binary cells, and how many each cell has."""
    values, counts = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        offsets, data = utf8(part)
        values.append(data[offsets[0] : offsets[-1]].view(kind))
        counts.append(np.diff(offsets) // np.dtype(kind).itemsize)
    return np.concatenate(values), np.concatenate(counts)


def _dealt(kind, at: np.ndarray, ids, hashes, doc, *values) -> Iterator[pa.RecordBatch]:
    """Row groups by the bucket ``at`` of each record; only the texts that a group names travel with it."""
    if not len(at):
        return
    if at.max() < 1 << 16 and (doc[1:] >= doc[:-1]).all():
        order = np.argsort(at.astype(np.uint16), kind="stable")  # a radix sort
    else:
        order = np.argsort(at.astype(np.int64) * len(ids) + doc)
    at, doc = at[order], doc[order]
    new = _firsts(at)
    named = np.flatnonzero(new | _firsts(doc))  # the first record of each text in each group
    edges = np.r_[np.flatnonzero(new), len(at)]
    width = 4 + sum(v.itemsize for v in values)
    lo = 0
    while lo < len(edges) - 1:
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + _BATCH_BYTES // width, "right")) - 1)
        start, end = edges[lo], edges[hi]
        own = named[slice(*np.searchsorted(named, [start, end]))]
        cuts, texts = edges[lo : hi + 1] - start, np.searchsorted(own, edges[lo : hi + 1])
        place = np.zeros(end - start, np.int64)
        place[own - start] = 1
        place = np.cumsum(place) - 1 - np.repeat(texts[:-1], np.diff(cuts))
        pick = order[start:end]
        cells = [_cells(ids[doc[own]], texts), _cells(hashes[doc[own]], texts), _cells(place.astype(np.uint32), cuts)]
        cells += [_cells(v[pick], cuts) for v in values] + [pa.nulls(hi - lo, pa.binary())] * (3 - len(values))
        groups = [pa.array(np.full(hi - lo, kind, np.int32)), pa.array(at[edges[lo:hi]].astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*groups, *cells], ["kind", "bucket", "ids", "hashes", "doc", "a", "b", "c"])
        lo = hi


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash."""
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _doc_bucket(ids, doc, buckets):
    spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (spread % np.uint64(buckets))[doc]


def _merged(doc, start, end):
    """Runs joined where they overlap or touch, by text."""
    base = doc.astype(np.int64) << 32
    order = np.argsort(base + start)
    base, end = base[order], end[order].astype(np.int64)
    start = start[order].astype(np.int64)
    reach = np.maximum.accumulate(base + end)
    new = np.r_[True, base[1:] + start[1:] > reach[:-1]]
    lo = np.flatnonzero(new)
    hi = np.r_[lo[1:], len(base)] - 1
    return base[lo] >> 32, start[lo].astype(np.uint32), (reach[hi] - base[lo]).astype(np.uint32)


def _spans(ids, hashes, doc, start, end, buckets) -> Iterator[pa.RecordBatch]:
    """Removed runs, joined where they overlap or touch, by text."""
    if not len(doc):
        return
    doc, start, end = _merged(doc, start, end)
    yield from _dealt(SPAN, _doc_bucket(ids, doc, buckets), ids, hashes, doc, start, end)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted records differ from the one before in any key."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _ties(key: np.ndarray) -> np.ndarray:
    """Records whose key others have too, equal ones side by side."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    tied = np.zeros(len(key), bool)
    tied[1:] = same
    tied[:-1] |= same
    return order[tied]


def _text_order(ids, hashes):
    """Rank of each text by (id, hash), and whether it is the first of its rank."""
    order = np.lexsort((hashes, ids))
    new = _firsts(ids[order], hashes[order])
    rank, first = np.empty(len(ids), np.int64), np.empty(len(ids), bool)
    rank[order], first[order] = np.cumsum(new) - 1, new
    return rank, first


def _read(batches, size) -> Iterator[tuple]:
    """Ids, hashes, row offsets and bytes of texts, in chunks, with the other columns."""
    for batch in batches:
        ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        offsets, data = utf8(batch.column(2))
        for lo, hi in chunks(offsets, size):
            part = data[offsets[lo] : offsets[hi]]
            yield ids[lo:hi], hashes[lo:hi], offsets[lo : hi + 1] - offsets[lo], part, batch.slice(lo, hi - lo)


def _samples(width, block, blocks, buckets, doc_buckets):
    """Distinct cover samples of one block of suffix buckets, and ties settled inside the task."""
    short = width - PERIOD + 1

    def run(batches):
        roll = WindowHash(1)
        pattern = np.zeros(0, np.int64)
        held, texts, n_texts, n = [], [], 0, 0

        def flush():
            ids, hashes = (np.concatenate([t[i] for t in texts]) for i in (0, 1))
            key, context, doc, pos = (np.concatenate([h[i] for h in held]) for i in range(4))
            yield from _settle_samples(width, ids, hashes, key, context, doc, pos, block, blocks, buckets, doc_buckets)

        for ids, hashes, offsets, data, _ in _read(batches, _PIECE):
            size = np.diff(offsets)
            longest = int(size.max(initial=0))
            if longest >= width:
                if not len(pattern) or pattern[-1] < longest:
                    periods = np.arange(longest // PERIOD + 2) * PERIOD
                    pattern = (periods[:, None] + np.array(COVER)).ravel()
                count = np.where(size >= width, np.searchsorted(pattern, size - short, "right"), 0)
                doc = np.repeat(np.arange(len(size)), count)
                pos = pattern[np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)]
                roll.read(data)
                at = offsets[doc] + pos
                key = roll.windows(at, at + short)
                mine = np.flatnonzero(_bucket(key, buckets * blocks) // buckets == block)
                key, doc, pos, at = key[mine], doc[mine], pos[mine], at[mine]
                left, right = np.minimum(pos, PERIOD - 1), np.minimum(size[doc] - pos, width)
                context = roll.windows(at - left, at + right)
                context ^= (left * 1024 + right).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                held.append((key, context, doc + n_texts, pos))
                texts.append((ids, hashes))
                n_texts += len(ids)
                n += len(key)
            if n >= _SAMPLES_AT_ONCE:
                yield from flush()
                held, texts, n_texts, n = [], [], 0, 0
        if n:
            yield from flush()

    return run


def _settle_samples(width, ids, hashes, key, context, doc, pos, block, blocks, buckets, doc_buckets):
    rank, first = _text_order(ids, hashes)
    if not first.all():  # a repeated row is one text
        mine = first[doc]
        key, context, doc, pos = key[mine], context[mine], doc[mine], pos[mine]
    tied = _ties(key)
    tied = tied[np.lexsort((pos[tied], rank[doc[tied]], context[tied], key[tied]))]
    head = _firsts(key[tied], context[tied])
    later, heads = tied[~head], tied[head]
    group = np.cumsum(_firsts(key[heads])) - 1 if len(heads) else np.zeros(0, np.int64)
    many = np.bincount(group)[group] > 1 if len(heads) else np.zeros(0, bool)
    ask = heads[many]
    evidence = np.r_[True, group[many][1:] != group[many][:-1]][: len(ask)] if len(ask) else np.zeros(0, bool)
    sent, flag = np.ones(len(key), bool), np.zeros(len(key), np.uint32)
    sent[later], sent[ask[~evidence]], flag[ask[evidence]] = False, False, 1
    send = np.flatnonzero(sent)
    at = _bucket(key[send], buckets * blocks) - block * buckets
    yield from _dealt(SAMPLE, at, ids, hashes, doc[send], key[send], context[send], _with_flag(pos[send], flag[send]))
    yield from _spans(ids, hashes, doc[later], *_reach(pos[later], width), doc_buckets)
    yield from _dealt(ASK, _doc_bucket(ids, doc[ask], doc_buckets), ids, hashes, doc[ask], pos[ask].astype(np.uint32))


def _with_flag(pos, flag):
    return pos.astype(np.uint32) | (flag << np.uint32(31))


def _reach(pos, width):
    """Bytes of all windows that a sample at ``pos`` can anchor; the end may pass the text's."""
    pos = pos.astype(np.int64)
    return pos - np.minimum(pos, PERIOD - 1), pos + width


def _gather(table: pa.Table, names: dict) -> tuple:
    """The records of all row groups of a bucket, with the ids and hashes of their texts."""
    ids, n_texts = _flat(table.column("ids"), np.int64)
    hashes, _ = _flat(table.column("hashes"), np.int64)
    doc, n = _flat(table.column("doc"), np.uint32)
    doc = doc + np.repeat(np.cumsum(n_texts) - n_texts, n)
    return ids, hashes, doc, *(_flat(table.column(name), kind)[0] for name, kind in names.items())


def _decide(width, doc_buckets):
    """Settle the ties of one bucket; spans and questions pass through."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        if kind == SAMPLE:
            out = list(_decide_samples(table, width, doc_buckets))
        elif kind == WINDOW:
            out = list(_decide_windows(table, width, doc_buckets))
        else:
            return table
        return pa.Table.from_batches(out, table.schema) if out else table.slice(0, 0)

    return run


def _decide_samples(table, width, doc_buckets):
    ids, hashes, doc, key, context, pos = _gather(table, {"a": np.uint64, "b": np.uint64, "c": np.uint32})
    flag = pos >> np.uint32(31) > 0
    pos = (pos & np.uint32((1 << 31) - 1)).astype(np.int64)
    tied = _ties(key)
    if not len(tied):
        return
    rank, _ = _text_order(ids, hashes)
    tied = tied[np.lexsort((pos[tied], rank[doc[tied]], context[tied], key[tied]))]
    group = np.cumsum(_firsts(key[tied])) - 1
    head = _firsts(key[tied], context[tied])
    mixed = (np.bincount(group, head) > 1) | (np.bincount(group, flag[tied]) > 0)
    # the place of the first one of each context, to leave repeated rows of a text alone
    lead = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
    again = (rank[doc[lead]] == rank[doc[tied]]) & (pos[lead] == pos[tied])
    later = tied[~again & ~flag[tied]]
    ask = tied[again & mixed[group] & ~flag[tied]]
    yield from _spans(ids, hashes, doc[later], *_reach(pos[later], width), doc_buckets)
    at = _doc_bucket(ids, doc[ask], doc_buckets)
    yield from _dealt(ASK, at, ids, hashes, doc[ask], pos[ask].astype(np.uint32))


def _by_text(table: pa.Table) -> pa.Table:
    """One row per text of a bucket: its merged spans, or the distinct positions asked about."""
    kind = table.column("kind")[0].as_py()
    names = {"a": np.uint32} | ({"b": np.uint32} if kind == SPAN else {})
    ids, hashes, doc, a, *b = _gather(table, names)
    rank, first = _text_order(ids, hashes)
    doc = rank[doc]
    if kind == SPAN:
        doc, a, b = _merged(doc, a, b[0])
    else:
        own = (doc << 32) + a
        own.sort()
        own = own[_firsts(own)]
        doc, a = own >> 32, (own & 0xFFFFFFFF).astype(np.uint32)
    edges = np.r_[np.flatnonzero(_firsts(doc)), len(doc)]
    texts = np.empty(int(first.sum()), np.int64)
    texts[rank[first]] = np.flatnonzero(first)
    texts = texts[doc[edges[:-1]]]
    arrays = [pa.array(ids[texts]), pa.array(hashes[texts]), _cells(a, edges), _cells(b, edges) if kind == SPAN else pa.nulls(len(texts), pa.binary())]
    return pa.Table.from_arrays(arrays, ["id", "hash", "a", "b"])


def _asked(batch, offsets, width) -> tuple[np.ndarray, np.ndarray]:
    """Text and start of all windows that the samples asked about can anchor; these come in order."""
    pos, n = _flat(batch.column(3), np.uint32)
    doc, pos = np.repeat(np.arange(len(n)), n), pos.astype(np.int64)
    lo = np.maximum(pos - PERIOD + 1, 0)
    hi = np.minimum(pos, np.diff(offsets)[doc] - width) + 1
    lo, hi, doc = (v[hi > lo] for v in (lo, hi, doc))
    lo, hi = offsets[doc] + lo, offsets[doc] + hi
    lo[1:] = np.maximum(lo[1:], hi[:-1])
    n = hi - lo
    doc, at = np.repeat(doc, n), np.repeat(lo - np.cumsum(n) + n, n)
    at += np.arange(len(at))
    return doc, at - offsets[doc]


def _windows(width, block, blocks, buckets, doc_buckets):
    """Ranks of the asked windows of one block of buckets; repeats inside the task are settled."""

    def run(batches):
        rolls = WindowHash(2), WindowHash(3)
        held, texts, n_texts, n = [], [], 0, 0

        def flush():
            ids, hashes = (np.concatenate([t[i] for t in texts]) for i in (0, 1))
            one, two, doc, pos = (np.concatenate([h[i] for h in held]) for i in range(4))
            yield from _settle_windows(width, ids, hashes, one, two, doc, pos, block, blocks, buckets, doc_buckets)

        for ids, hashes, offsets, data, batch in _read(batches, _PIECE):
            doc, pos = _asked(batch, offsets, width)
            at = offsets[doc] + pos
            rolls[0].read(data)
            one = rolls[0].windows(at, at + width)
            mine = np.flatnonzero(_bucket(one, buckets * blocks) // buckets == block)
            one, doc, pos, at = one[mine], doc[mine], pos[mine], at[mine]
            rolls[1].read(data)
            held.append((one, rolls[1].windows(at, at + width), doc + n_texts, pos))
            texts.append((ids, hashes))
            n_texts += len(ids)
            n += len(one)
            if n >= _SAMPLES_AT_ONCE:
                yield from flush()
                held, texts, n_texts, n = [], [], 0, 0
        if n:
            yield from flush()

    return run


def _settle_windows(width, ids, hashes, one, two, doc, pos, block, blocks, buckets, doc_buckets):
    rank, first = _text_order(ids, hashes)
    if not first.all():  # a repeated row is one text
        mine = first[doc]
        one, two, doc, pos = one[mine], two[mine], doc[mine], pos[mine]
    tied = _ties(one)
    tied = tied[np.lexsort((pos[tied], rank[doc[tied]], two[tied], one[tied]))]
    head = _firsts(one[tied], two[tied])
    later = tied[~head]
    sent = np.ones(len(one), bool)
    sent[later] = False
    send = np.flatnonzero(sent)
    yield from _spans(ids, hashes, doc[later], pos[later], pos[later] + width, doc_buckets)
    at = _bucket(one[send], buckets * blocks) - block * buckets
    yield from _dealt(WINDOW, at, ids, hashes, doc[send], one[send], two[send], pos[send].astype(np.uint32))


def _decide_windows(table, width, doc_buckets):
    ids, hashes, doc, one, two, pos = _gather(table, {"a": np.uint64, "b": np.uint64, "c": np.uint32})
    rank, _ = _text_order(ids, hashes)
    pos = pos.astype(np.int64)
    tied = _ties(one)
    tied = tied[np.lexsort((pos[tied], rank[doc[tied]], two[tied], one[tied]))]
    head = _firsts(one[tied], two[tied])
    lead = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
    later = tied[(rank[doc[lead]] != rank[doc[tied]]) | (pos[lead] != pos[tied])]
    yield from _spans(ids, hashes, doc[later], pos[later], pos[later] + width, doc_buckets)


def _cut_out(batches):
    """The bytes outside a text's spans."""
    for batch in batches:
        offsets, data = utf8(batch.column(0).field("text"))
        runs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        sizes, removed, kept = np.diff(offsets), [], []
        for i, (a, b) in enumerate(runs):
            text = data[offsets[i] : offsets[i + 1]]
            if a is None:
                removed.append([])
                kept.append(text.tobytes())
                continue
            a = np.frombuffer(a, np.uint32).astype(np.int64)
            b = np.minimum(np.frombuffer(b, np.uint32).astype(np.int64), len(text))
            removed.append([{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)])
            pieces = zip(np.r_[0, b].tolist(), np.r_[a, len(text)].tolist(), strict=True)
            kept.append(b"".join(text[s:e].tobytes() for s, e in pieces))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
            ["row", "n_bytes", "removed", "kept"],
        )
