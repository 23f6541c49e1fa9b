"""Byte-level BPE by a pair occurrence index, and its inverse.

The distinct words of a partition lie one after another as linked symbols. An
index maps each pair of neighbouring symbols to all its positions. Active pairs
are applied in ascending rank; a merge touches only the lists of the pairs to its
left and right. A word's symbols then are its ids, looked up for every text.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import rest, small_batches

#: Fixed value: the pattern that splits text before merging, as byte-level BPE files imply it.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 100_000  # words remembered between batches of a task; physical only
PIECE_BYTES, PIECE_IDS = 1 << 20, 1 << 18  # of the rows encoded and decoded at a time, one row at least; physical only


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs(text, ...)`` with ``ids array<int>``: the text's tokens.

    ``tokenizer`` is the path of a byte-level BPE file in JSON, readable on every
    executor. Added tokens in a text become their own ids. A null text counts as
    empty and has no ids; ``ids`` replaces a column of this name. Rows stay as
    they are otherwise, repeated ones too. A text is held by one task.
    """
    other = rest(docs, "ids")
    return _mapped(docs, other, "ids array<int>", _encode(tokenizer))


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows(ids, ...)`` with ``decoded``: the text of the ids, added tokens included.

    Bytes that are no UTF-8 become U+FFFD; null or empty ids give an empty text,
    ids outside the vocabulary nothing. ``decoded`` replaces a column of this name.
    """
    other = rest(rows, "decoded")
    return _mapped(rows, other, "decoded string", _decode(tokenizer))


def _mapped(df, other, new, run):
    small_batches(df.sparkSession)
    held = df.select(F.struct(*other).alias("row"))
    name = new.split()[0]
    schema = f"row {held.schema['row'].dataType.simpleString()}, {new}"
    return held.mapInArrow(run, schema).select("row.*", name)


# -- inside tasks ----------------------------------------------------------------------------


def _letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _pieces(batches: Iterable[pa.RecordBatch], sizes, limit: int) -> Iterator[pa.RecordBatch]:
    """``batches`` in slices of one row, or of rows whose ``sizes`` add up to ``limit`` at most."""
    for batch in batches:
        ends = np.cumsum(sizes(batch))
        low = 0
        while low < batch.num_rows:
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(low, high - low)
            low = high


def _text_bytes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.binary_length(batch.column(0).field("text")), 0).to_numpy().astype(np.int64)


def _id_counts(batch: pa.RecordBatch) -> np.ndarray:
    return np.diff(batch.column(0).field("ids").offsets.to_numpy().astype(np.int64))


class Vocabulary:
    """Ranks and bytes of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _letters()
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.bytes = [b""] * (max(names) + 1)
        for i, t in names.items():
            known = all(c in letters for c in t)
            self.bytes[i] = bytes(letters[c] for c in t) if known else t.encode()
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left], vocab[right]] = rank, vocab[left + right]


class Merger:
    """The merges as sorted keys of symbol pairs, to look up many pairs at once."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = sorted((left << 32 | right, rank, merged) for (left, right), (rank, merged) in vocabulary.ranks.items())
        self.keys, self.rank, _ = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.merge = {rank: (key >> 32, key & 0xFFFFFFFF, merged) for key, rank, merged in pairs}
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary does not merge it."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at], -1)


def merge_words(words: list[bytes], merger: Merger) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one word after another, and where each word begins.

    ``places`` is the index: the positions of each pair, by its rank. Ranks are applied
    in ascending order to all their positions at once; a merge lists the pairs it forms.
    """
    size = np.array([len(w) for w in words], np.int64) + 1
    ends = np.cumsum(size)
    n = int(ends[-1]) if len(words) else 0
    inside = np.ones(n, bool)
    inside[ends - 1] = False
    symbol = np.full(n, -1, np.int64)  # -1 ends a word: no pair reaches over it
    symbol[inside] = merger.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    places: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def listed(rank: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True):
            if r in places:
                places[r].append(part)
            else:
                places[r] = [part]
                heapq.heappush(active, r)

    if n:
        rank = merger.ranks(symbol[:-1], symbol[1:])
        known = np.flatnonzero(rank >= 0)
        if len(known):
            listed(rank[known], known)
    while active:
        rank = heapq.heappop(active)
        left, right, merged = merger.merge[rank]
        at = places.pop(rank)
        at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
        at = at[symbol[at] == left]  # others were merged since they were listed
        second = after[at]
        good = symbol[second] == right
        at, second = at[good], second[good]
        if left == right and len(at) > 1:  # of a run of equal symbols, every other pair
            order = np.argsort(at)
            at, second = at[order], second[order]
            new = np.r_[True, second[:-1] != at[1:]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            even = (np.arange(len(at)) - start) % 2 == 0
            at, second = at[even], second[even]
        if not len(at):
            continue
        third = after[second]
        symbol[at], symbol[second] = merged, -2
        after[at] = third
        before[third] = at
        first = before[at]
        pairs_at = np.unique(np.concatenate([at, first[first >= 0]]))
        new = merger.ranks(symbol[pairs_at], symbol[after[pairs_at]])
        known = new >= 0
        if known.any():
            listed(new[known], pairs_at[known])
    kept = symbol >= 0
    count = np.add.reduceat(kept.astype(np.int64), np.r_[0, ends[:-1]]) if n else np.zeros(0, np.int64)
    return symbol[kept], np.r_[0, np.cumsum(count)]


#: The same split for texts of these characters, for which the standard library's classes agree.
_COMMON = re.compile("[^\x00-\x1b\x20-\x7f\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")
_QUICK = r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


def splitter(vocabulary: Vocabulary):
    """A function from a text to its words; an added token is a word in a tuple of its own."""
    quick, full, uncommon = re.compile(_QUICK).findall, regex.compile(WORDS).findall, _COMMON.search
    added = sorted(vocabulary.added, key=len, reverse=True)
    special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def plain(text: str) -> list[str]:
        return full(text) if uncommon(text) else quick(text)

    def run(text: str) -> list:
        if special is None or not special.search(text):
            return plain(text)
        return [w for i, part in enumerate(special.split(text)) for w in ([(part,)] if i % 2 else plain(part))]

    return run


def _encode(path):
    def run(batches):
        vocabulary = Vocabulary(path)
        merger, split = Merger(vocabulary), splitter(vocabulary)
        number: dict = defaultdict(count().__next__)  # of each distinct word met
        ids, ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
        for batch in _pieces(batches, _text_bytes, PIECE_BYTES):
            if len(number) > WORDS_KEPT:
                number = defaultdict(count().__next__)
                ids, ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
            known = len(number)
            place, sizes = [], [0]
            for text in batch.column(0).field("text").to_pylist():
                place += [number[w] for w in split(text or "")]
                sizes.append(len(place))
            fresh = list(islice(number, known, None))
            more, starts = merge_words([w.encode() if isinstance(w, str) else b"" for w in fresh], merger)
            special = [i for i, w in enumerate(fresh) if isinstance(w, tuple)]
            if special:  # an added token has its own id
                more = np.insert(more, starts[special], [vocabulary.added[fresh[i][0]] for i in special])
                starts = starts + np.searchsorted(special, np.arange(len(starts)), "left")
            ids, ends = np.concatenate([ids, more]), np.concatenate([ends, ends[-1] + starts[1:]])
            place = np.array(place, np.int64)
            length = (ends[1:] - ends[:-1])[place]
            upto = np.cumsum(length)
            flat = ids[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(ends[place] - (upto - length), length)]
            offsets = np.r_[0, upto][sizes]
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), arrays], ["row", "ids"])

    return run


def _decode(path):
    def run(batches):
        pieces = Vocabulary(path).bytes
        data = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.array([len(p) for p in pieces], np.int64)
        start = np.cumsum(length) - length
        for batch in _pieces(batches, _id_counts, PIECE_IDS):
            column = batch.column(0).field("ids")
            offsets = column.offsets.to_numpy().astype(np.int64)
            lists = np.diff(offsets)
            if column.null_count:
                lists = np.where(column.is_valid().to_numpy(zero_copy_only=False), lists, 0)
            flat = column.values.to_numpy(zero_copy_only=False)
            flat = np.concatenate([flat[a : a + n] for a, n in zip(offsets[:-1].tolist(), lists.tolist(), strict=True)] or [flat[:0]])
            known = ~np.isnan(flat) & (flat >= 0) & (flat < len(pieces))
            ids = np.where(known, flat, 0).astype(np.int64)
            size = np.where(known, length[ids], 0)
            upto = np.cumsum(size)
            text = data[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(start[ids] - (upto - size), size)].tobytes()
            cuts = np.r_[0, upto][np.r_[0, np.cumsum(lists)]].tolist()
            out = [text[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "decoded"])

    return run
