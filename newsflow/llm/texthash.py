"""Vectorised hashes of byte windows, words and word shingles of UTF-8 texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LONG = 128
CHUNK_BYTES = 2_000_000  # texts hashed in one go; physical only, results do not depend on it


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WindowHash:
    """Hashes of any byte windows of a text from one pass over its bytes.

    The polynomial hash over random byte values is taken from prefix sums; the
    factor's inverse moves every window to the same power.
    """

    def __init__(self, seed: int):
        random = np.random.RandomState(seed)
        values = random.randint(0, 1 << 32, (2, 257), dtype=np.uint64)
        values = (values[0] << np.uint64(32)) | values[1]
        self.values = values[:256]
        factor = int(values[256]) | 1
        self.factors = np.array([factor, pow(factor, -1, 1 << 64)], dtype=np.uint64)
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def read(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if n > len(self.powers[0]):
            for i in (0, 1):
                steps = np.full(-(-n >> 16) << 16, self.factors[i], np.uint64)  # room for pieces a little longer
                steps[0] = 1
                self.powers[i] = np.multiply.accumulate(steps)
        terms = self.values.take(data, mode="clip")
        terms *= self.powers[0][: n - 1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def windows(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = self.sums[ends] - self.sums[starts]
        found *= self.powers[1][starts]
        return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a column of texts; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    column = pc.fill_null(column, pa.scalar(b"", pa.large_binary()))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes, one row at least."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(n, max(start + 1, end))
        yield start, end
        start = end


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(
    roll: WindowHash, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _BREAK
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and the place of the first word of each text.

    ``offsets`` begin at 0 and end at the length of ``data``; ``breaks`` says which bytes
    are outside words. A word ends with its text, even if the next text begins with one. Words of
    more than ``_LONG`` bytes are hashed by BLAKE2: polynomials modulo 2^64 collide on long regular ones.
    """
    low = _LOWER[data]
    inside = np.zeros(len(low) + 2, bool)
    np.logical_not(breaks[low], out=inside[1:-1])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    roll.read(low)
    hashes = roll.windows(starts, ends)
    for i in np.flatnonzero(ends - starts > _LONG):
        digest = hashlib.blake2b(low[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(roll: WindowHash, data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text, the sorted hashes of its distinct ``k``-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer
    words has its whole sequence as its only shingle, one without words none.
    """
    words, first = word_hashes(roll, data, offsets)
    factors = [mix(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(k)]
    grams = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i, factor in enumerate(factors):
        grams += words[i : i + len(grams)] * factor
    grams = mix(grams)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            whole = sum(int(w) * int(f) for w, f in zip(words[a:b], factors, strict=False)) + b - a
            yield mix(np.array([whole & (1 << 64) - 1], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
