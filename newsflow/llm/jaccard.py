"""Exact n-gram Jaccard join: prefix filter, candidate clusters, and a prefix-tree join in each.

1. Texts with equal shingle sets form a class; only one text of a class goes on.
2. Shingles get one global order, rare ones first, by a fixed-size table of
   counts. Sets that reach the threshold share a shingle of their prefixes.
3. Classes that share one are compared by length and by parity sketches of 512 bits
   or 0.3 bits per shingle, which bound the symmetric difference from below, so no link is lost. Large
   groups are compared block by block; a task sends a spanning forest, not pairs.
4. In each cluster of what is left, sets are stored as paths of a prefix tree in
   one order. A set walks the tree, sharing the overlap of common paths, and
   leaves a subtree when what remains cannot reach the threshold. This settles
   every link exactly; large clusters are again cut into blocks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.components import components
from newsflow.llm.tables import forget, keep, partitions, rest, shuffles_dropped
from newsflow.llm.texthash import WindowHash, chunks, shingle_sets, utf8

CELLS, SLOTS, BITS = 1 << 23, 64, 512  # of the table of counts: one byte a cell
CELL_SHIFT = np.uint64(64 - CELLS.bit_length() + 1)
ROUNDS = 8  # of the comparison, at most
GROUP_BLOCK, CLUSTER_BLOCK = 512, 512  # physical: members compared in one go
CLUSTER_SHINGLES = 2_000_000  # and at most about so many shingles of a cluster
BUCKET_BYTES, ROW_BYTES = 64_000_000, 200  # physical: what a task holds of hits, and a hit's size without its sketch
_SIGNED = "id long, n long, digest binary, prefix array<long>, sketch binary"


def link_documents(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``n_shingles``, ``component_id`` and ``n_links``.

    Two texts link when 100 * |intersection| >= ``percent`` * |union| of their sets
    of distinct ``words``-word shingles (A-Z lower-cased, words split at ASCII
    white space; fewer words form one shingle). ``component_id`` is the smallest
    ``doc_id`` reachable by links, ``n_links`` the number of other rows it links with.

    Null texts and texts without words have an empty set and link with nothing.
    Rows without ``doc_id`` take no part: their component is null and they have no
    links. Rows that share a ``doc_id`` count as one document, which links as any
    of its rows does. Other columns but ``text`` are kept; the three new ones
    replace columns of these names. A set is held in memory by one task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    with shuffles_dropped(spark):
        counted = texts.mapInArrow(_counts(words), "slot int, counts binary")
        scales = counted.groupBy("slot").applyInArrow(_scales, "slot int, counts binary").collect()  # 8 MiB, whatever the input
        scale = np.zeros(CELLS, np.uint8)
        for row in scales:
            scale[row.slot * (CELLS // SLOTS) : (row.slot + 1) * (CELLS // SLOTS)] = np.frombuffer(row.counts, np.uint8)
        shared = spark.sparkContext.broadcast(scale)
        signed = keep(texts.mapInArrow(_sign(words, percent, shared), _SIGNED), "signed")
        classes = keep(
            signed.where("id IS NOT NULL AND n > 0")
            .groupBy("digest", "n", "prefix", "sketch")
            .agg(F.min("id").alias("class"), F.count("*").alias("size")),
            "classes",
        )
        clusters = components(_candidates(classes, percent))
        found = _compare(texts, classes, clusters, words, percent)
        member = keep(
            signed.where("id IS NOT NULL AND n > 0").select("id", "digest").join(classes.select("digest", "class", "size"), "digest"),
            "members",
        )
        first = member.groupBy("id").agg(F.min("class").alias("v"))
        same_id = member.select("id", F.col("class").alias("u")).join(first, "id").where("u <> v").select("u", "v")
        linked = components(found.where("v IS NOT NULL").select("u", "v").union(same_id))
        counts = found.where("v IS NULL").groupBy("digest").agg(F.sum("links").alias("links"))
        per_class = (
            classes.select("digest", F.col("class").alias("node"), "size")
            .join(linked, "node", "left")
            .join(counts, "digest", "left")
            .select(
                "digest",
                F.coalesce("component", "node").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            )
        )
        per_class = keep(per_class, "labels")
    new = ("n_shingles", "component_id", "n_links")
    other = rest(docs, "text", "doc_id", *new)
    if other:
        held = docs.select(F.struct("doc_id", "text", *other).alias("row"))
        kind = held.schema["row"].dataType.simpleString()
        rows = held.mapInArrow(_sign_rows(words), f"row {kind}, n long, digest binary")
        rows = rows.withColumn("row", F.col("row").dropFields("text"))
    else:
        rows = signed.select(F.struct(F.col("id").alias("doc_id")).alias("row"), "n", "digest")
    known = F.col("row.doc_id").isNotNull() & (F.col("n") > 0)
    some = rows.where(known).join(per_class, "digest")
    none = rows.where(~known).withColumns({"component": F.col("row.doc_id").cast("long"), "links": F.lit(0).cast("long")})
    both = some.unionByName(none, allowMissingColumns=True)
    return both.select(
        "row.*", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("links").alias("n_links")
    )


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Edges that connect all classes whose sets might reach the threshold."""
    spark = classes.sparkSession
    narrow = classes.select("class", "n", F.posexplode("prefix").alias("at", "token"))
    # shingles of one text and its near copies mostly have the same members: one of them tells as much as all,
    # and long texts would send their sketches once per shingle otherwise
    alike = [F.sum(F.xxhash64("class", F.lit(i)).cast("decimal(38,0)")).alias(f"members_{i}") for i in (1, 2)]
    left = F.min(F.col("n") - F.col("at")).alias("left")
    often = narrow.groupBy("token").agg(F.count("*").alias("members"), left, F.sum("n").alias("both"), *alike)
    # a pair that links does so by what follows its first common shingle in both; where that is too little
    # for the only two members, another shingle shows the pair or it does not link
    often = often.where(f"members > 2 OR members = 2 AND {100 + percent} * left >= {percent} * both")
    often = often.groupBy("members", "members_1", "members_2").agg(F.min("token").alias("token")).select("token", "members")
    hits = keep(narrow.select("class", "token").join(often, "token"), "hits")
    blocks = F.ceil(F.col("members") / GROUP_BLOCK)
    sizes = classes.select("class", (F.octet_length("sketch") + ROW_BYTES).alias("bytes"))
    volume = hits.join(sizes, "class").agg(F.sum(F.col("bytes") * blocks)).first()[0]
    if not volume:
        return spark.createDataFrame([], "u long, v long")
    rows = (
        hits.join(classes.select("class", "n", "sketch"), "class")
        .withColumn("at", F.pmod(F.xxhash64("class"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .withColumns({"lo": F.least("at", "other"), "hi": F.greatest("at", "other")})
    )
    buckets = max(partitions(spark), math.ceil(volume / BUCKET_BYTES))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("token", "lo", "hi"), F.lit(buckets)).cast("int"))
    rows = rows.select("bucket", "token", "lo", "hi", "at", "class", "n", "sketch")
    return keep(rows.groupBy("bucket").applyInArrow(_forests(percent), "u long, v long"), "candidates")


def _compare(texts: DataFrame, classes: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """Exact links inside clusters: a spanning forest (u, v), and per class the rows it links with.

    Sets are made once. A set of a large cluster goes to each pair of blocks it is in, so these
    are compared in rounds, whose copies follow each other on disk.
    """
    spark = texts.sparkSession
    named = keep(clusters.join(classes.select(F.col("class").alias("node"), "digest", "size", "n"), "node"), "named")
    blocks = F.greatest(F.ceil(F.count("*") / CLUSTER_BLOCK), F.ceil(F.sum("n") / CLUSTER_SHINGLES))
    sizes = named.groupBy("component").agg(blocks.alias("blocks"))
    held = keep(named.join(sizes, "component").select("node", "component", "blocks", "digest", "size", "n"), "clustered")
    volume, blocks = held.agg(F.sum(F.col("n") * F.col("blocks")), F.max("blocks")).first()
    volume, rounds = volume or 0, min(ROUNDS, blocks or 1)  # sets of small clusters are not copied
    buckets = max(partitions(spark), math.ceil(volume * 8 / 64_000_000))
    wanted = held.groupBy(F.col("node").alias("id")).agg(F.min("component").alias("component"))
    sets = texts.join(wanted, "id").mapInArrow(_sets(words), "id long, digest binary, shingles binary")
    sets = keep(sets.join(held.withColumnRenamed("node", "id"), ["id", "digest"]), "sets")
    rows = (
        sets.withColumn("at", F.pmod(F.xxhash64("id", "digest"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .withColumns({"lo": F.least("at", "other"), "hi": F.greatest("at", "other")})
        .withColumn("bucket", F.pmod(F.xxhash64("component", "lo", "hi"), F.lit(buckets)).cast("int"))
        .select("bucket", "component", "lo", "hi", "at", "id", "digest", "size", "n", "shingles")
    )
    found = None
    for number in range(rounds):
        some = rows.where(F.pmod("bucket", F.lit(rounds)) == number)
        part = keep(some.groupBy("bucket").applyInArrow(_join_blocks(percent), "u long, v long, digest binary, links long"), "compared")
        found = part if found is None else found.union(part)
    found = keep(found, "links")
    forget(sets, held, named)
    return found


# -- inside tasks ----------------------------------------------------------------------------


def _sets_of(batch, column, words, roll):
    offsets, data = utf8(column)
    for lo, hi in chunks(offsets):
        yield from shingle_sets(roll, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of a power of two of cells: enough to tell unlike sets apart."""
    size = max(BITS, 1 << int(0.3 * len(shingles)).bit_length())
    bits = np.bincount(((shingles >> np.uint64(8)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _differ(sketches: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lower bounds of the symmetric differences; of unequal sketches the larger is folded."""
    size = np.array([len(x) for x in sketches])
    least = np.minimum(size[left], size[right])
    out = np.zeros(len(left), np.int64)
    for cells in np.unique(least).tolist():
        pick = np.flatnonzero(least == cells)
        rows, place = np.unique(np.concatenate([left[pick], right[pick]]), return_inverse=True)
        folded = np.stack([np.bitwise_xor.reduce(sketches[r].reshape(-1, cells), axis=0) for r in rows.tolist()])
        for lo in range(0, len(pick), 1 << 16):
            a, b = place[: len(pick)][lo : lo + (1 << 16)], place[len(pick) :][lo : lo + (1 << 16)]
            out[pick[lo : lo + (1 << 16)]] = np.bitwise_count(folded[a] ^ folded[b]).sum(axis=1, dtype=np.int64)
    return out


def _counts(words):
    def run(batches):
        roll, counts = WindowHash(1), np.zeros(CELLS, np.uint32)

        def add(held):
            cells = np.sort((np.concatenate(held) >> CELL_SHIFT).astype(np.uint32))
            start = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            counts[cells[start]] += np.diff(np.r_[start, len(cells)]).astype(np.uint32)

        for batch in batches:
            held, n = [], 0
            for s in _sets_of(batch, batch.column(1), words, roll):
                held.append(s)
                n += len(s)
                if n > 1_000_000:
                    add(held)
                    held, n = [], 0
            if n:
                add(held)
        # a task's counts stop at 255: they only choose the order, and most cells hold a few
        for slot, part in enumerate(np.minimum(counts, 255).astype(np.uint8).reshape(SLOTS, -1)):
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {"slot": pa.array([slot], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())}
                )

    return run


def _scales(table: pa.Table) -> pa.Table:
    """Powers of two of a slot's summed counts."""
    total = np.zeros(CELLS // SLOTS, np.uint64)
    for x in table.column("counts"):
        total += np.frombuffer(x.as_buffer(), np.uint8)
    scale = np.floor(np.log2(np.maximum(total, 1))).astype(np.uint8)
    return pa.table({"slot": table.column("slot").slice(0, 1), "counts": pa.array([scale.tobytes()], pa.binary())})


def _sign(words, percent, shared):
    def run(batches):
        roll, scale = WindowHash(1), shared.value
        for batch in batches:
            n, digests, prefixes, sketches = [], [], [], []
            for s in _sets_of(batch, batch.column(1), words, roll):
                n.append(len(s))
                digests.append(_digest(s))
                keep_n = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                order = np.argsort(scale[(s >> CELL_SHIFT).astype(np.int64)], kind="stable")
                prefixes.append(s[order[:keep_n]].view(np.int64))
                sketches.append(_sketch(s))
            ends = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *prefixes])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(sketches, pa.binary())],
                ["id", "n", "digest", "prefix", "sketch"],
            )

    return run


def _sign_rows(words):
    def run(batches):
        roll = WindowHash(1)
        for batch in batches:
            sets = list(_sets_of(batch, batch.column(0).field("text"), words, roll))
            n, digests = pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, digests], ["row", "n", "digest"])

    return run


def _sets(words):
    def run(batches):
        roll = WindowHash(1)
        for batch in batches:
            sets = list(_sets_of(batch, batch.column(1), words, roll))
            digests, flat = [_digest(s) for s in sets], [s.tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(flat, pa.binary())], ["id", "digest", "shingles"]
            )

    return run


def _forests(percent):
    """Spanning forests of the pairs of a bucket that pass the length and sketch bounds."""

    def run(table: pa.Table) -> pa.Table:
        token, lo, hi, at, node, n = (
            table.column(c).to_numpy() for c in ("token", "lo", "hi", "at", "class", "n")
        )
        order = np.lexsort((at, hi, lo, token))
        held = table.column("sketch").to_pylist()
        sketch = [np.frombuffer(held[i], np.uint64) for i in order.tolist()]
        token, lo, hi, at, node, n = (x[order] for x in (token, lo, hi, at, node, n))
        new = np.r_[True, (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, len(n)])
        group = np.cumsum(new) - 1

        def near(i, j):
            ok = (node[i] != node[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            ok = _differ(sketch, i, j) * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
            return i[ok], j[ok]

        pairs = [(np.zeros(0, np.int64),) * 2]
        few = np.flatnonzero(size[group] <= 32)
        for step in range(1, min(32, int(size.max()))):
            i = few[few + step < len(n)]
            pairs.append(near(i[group[i] == group[i + step]], i[group[i] == group[i + step]] + step))
        for g in np.flatnonzero(size > 32).tolist():
            left = right = np.arange(start[g], start[g] + size[g])
            if lo[start[g]] != hi[start[g]]:  # two blocks: each pair inside a block has its own group
                left, right = left[at[left] == lo[left]], right[at[right] == hi[right]]
            low, met = start[g], [pairs[0]]
            for part in np.array_split(left, -(-len(left) // 64)) if len(left) else []:
                met.append(near(np.repeat(part, len(right)), np.tile(right, len(part))))
            i, j = (np.concatenate(x) - low for x in zip(*met, strict=True))
            least = _labels(int(size[g]), i, j)  # the group's forest is held, not its pairs
            moved = np.flatnonzero(least != np.arange(size[g]))
            pairs.append((moved + low, least[moved] + low))
        left, right = (np.concatenate(x) for x in zip(*pairs, strict=True))
        names, place = np.unique(node, return_inverse=True)
        label = _labels(len(names), place[left], place[right])
        moved = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"u": pa.array(names[moved], pa.int64()), "v": pa.array(names[label[moved]], pa.int64())})

    return run


def _labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index each one reaches."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


class _Node:
    """A stretch of a prefix tree without branches, with what its subtree holds."""

    __slots__ = ("below", "children", "depth", "docs", "least", "mask", "most")

    def __init__(self, mask, below, depth):
        self.mask, self.below, self.depth = mask, below, depth
        self.children, self.docs = [], []
        self.least, self.most = 1 << 62, 0


def _bits(index: np.ndarray) -> int:
    if not len(index):
        return 0
    flags = np.zeros(int(index[-1]) + 1, np.uint8)
    flags[index] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _tree(paths: list[np.ndarray], sizes: list[int]) -> _Node:
    """A prefix tree of ascending paths, without nodes that have one way on."""
    order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
    root = _Node(0, 0, 0)

    def build(parent: _Node, lo: int, hi: int, depth: int) -> None:
        todo = [(parent, lo, hi, depth)]
        while todo:
            parent, lo, hi, depth = todo.pop()
            while lo < hi and len(paths[order[lo]]) == depth:
                parent.docs.append(order[lo])
                lo += 1
            while lo < hi:
                first = paths[order[lo]]
                end = lo + 1
                while end < hi and paths[order[end]][depth] == first[depth]:
                    end += 1
                last = paths[order[end - 1]]
                m = min(len(first), len(last))
                unlike = np.flatnonzero(first[depth:m] != last[depth:m])
                stop = depth + int(unlike[0]) if len(unlike) else m
                part = first[depth:stop]
                node = _Node(_bits(part), (1 << int(part[-1]) + 1) - 1, stop)
                for i in order[lo:end]:
                    node.least, node.most = min(node.least, sizes[i]), max(node.most, len(paths[i]))
                parent.children.append(node)
                todo.append((node, lo, end, stop))
                lo = end

    build(root, 0, len(order), 0)
    return root


def _walk(root: _Node, mask: int, size: int, percent: int, sizes: list[int]):
    """Texts of the tree that link with a set; subtrees that cannot are left."""
    own = mask.bit_count()
    todo = [(node, 0) for node in root.children]
    while todo:
        node, shared = todo.pop()
        shared += (mask & node.mask).bit_count()
        left = min(own - (mask & node.below).bit_count(), node.most - node.depth)
        if (100 + percent) * (shared + left) < percent * (size + node.least):
            continue
        for d in node.docs:
            if (100 + percent) * shared >= percent * (size + sizes[d]):
                yield d
        for child in node.children:
            todo.append((child, shared))


def _join_blocks(percent):
    """The prefix-tree join of every pair of blocks in a bucket."""

    def run(table: pa.Table) -> pa.Table:
        component, lo, hi, at, ids, weight, size = (
            table.column(c).to_numpy() for c in ("component", "lo", "hi", "at", "id", "size", "n")
        )
        digest, shingles = table.column("digest").to_pylist(), table.column("shingles")
        order = np.lexsort((at, hi, lo, component))
        new = np.zeros(len(order), bool)
        for x in (component, lo, hi):
            new[1:] |= x[order][1:] != x[order][:-1]
        new[:1] = True
        edges, totals = [], {}
        for group in np.split(order, np.flatnonzero(new)[1:]):
            seen: dict = {}
            for i in group.tolist():  # a repeated row counts once
                seen.setdefault((int(ids[i]), digest[i]), i)
            rows = np.array(list(seen.values()))
            sets = [np.frombuffer(shingles[i].as_py(), np.uint64) for i in rows.tolist()]
            values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            ranked = np.argsort(-count, kind="stable")
            rank = np.empty(len(values), np.int64)
            rank[ranked] = np.arange(len(values))
            rank[count < 2] = -1  # met once: shared with nothing here
            ends = np.cumsum([0, *map(len, sets)])
            paths = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                path = np.sort(rank[place[a:b]])
                paths.append(path[np.searchsorted(path, 0) :])
            split = lo[rows[0]] != hi[rows[0]]
            side = at[rows] == hi[rows] if split else np.ones(len(rows), bool)
            stored = np.flatnonzero(side).tolist()
            asking = np.flatnonzero(~side).tolist() if split else stored
            sizes = [int(size[rows[i]]) for i in stored]
            tree = _tree([paths[i] for i in stored], sizes)
            left, right = [], []
            for i in asking:
                for d in _walk(tree, _bits(paths[i]), int(size[rows[i]]), percent, sizes):
                    j = stored[d]
                    if i == j:
                        continue
                    left.append(i)
                    right.append(j)
                    totals[digest[rows[i]]] = totals.get(digest[rows[i]], 0) + int(weight[rows[j]])
                    if split:
                        totals[digest[rows[j]]] = totals.get(digest[rows[j]], 0) + int(weight[rows[i]])
            if left:
                label = _labels(len(rows), np.array(left), np.array(right))
                for i in np.flatnonzero(label != np.arange(len(rows))).tolist():
                    edges.append((int(ids[rows[i]]), int(ids[rows[label[i]]])))
        u, v = [e[0] for e in edges], [e[1] for e in edges]
        none, some = [None] * len(totals), [None] * len(edges)
        return pa.table(
            {
                "u": pa.array(u + none, pa.int64()),
                "v": pa.array(v + none, pa.int64()),
                "digest": pa.array(some + list(totals), pa.binary()),
                "links": pa.array(some + list(totals.values()), pa.int64()),
            }
        )

    return run
