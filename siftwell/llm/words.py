"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D (all ASCII, so UTF-8
characters are never cut).  A null text has no words.  Everything here works on
slices of bounded size, except that a single text is never split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Weights of places that are kept; those of later ones are computed by the same function.
_KEPT = 1 << 12
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _weight(place: np.ndarray, seed: int) -> np.ndarray:
    """An odd number for each place in a word, as unlike those of other places as random ones, however long the word."""
    return mix(place.astype(np.uint64) * _STEP + np.uint64(seed)) | np.uint64(1)


_SEEDS = (11, 29)
_LETTERS = [np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, 256, dtype=np.uint64) for seed in _SEEDS]
_WEIGHTS = [_weight(np.arange(_KEPT), 0x6A09E667F3BCC909 * seed % 2**64) for seed in _SEEDS]


def letters(which: int = 0) -> np.ndarray:
    """64 random bits for each byte."""
    return _LETTERS[which]


def weights(place: np.ndarray, which: int = 0) -> np.ndarray:
    """The weight of each place in a word."""
    if not len(place) or place.max() < _KEPT:
        return _WEIGHTS[which][place]
    return np.where(place < _KEPT, _WEIGHTS[which][np.minimum(place, _KEPT - 1)], _weight(place, 0x6A09E667F3BCC909 * _SEEDS[which] % 2**64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    got = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return got[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold at most limit bytes, or a single row; a worker's unused memory goes back at the end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64 bits for the bytes of each range, none of which is empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    lengths = end - start
    at = np.cumsum(lengths) - lengths
    within = np.arange(at[-1] + lengths[-1]) - np.repeat(at, lengths)
    values = letters(which)[data[within + np.repeat(start, lengths)]] * weights(within, which)
    return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))


class Words:
    """start and end of each word in data; words of row i are first[i] to first[i + 1]."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(column)
        if lower:
            self.data = LOWER[self.data]
        inside = ~_SEPARATOR[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = self.offsets[1:-1]
        cuts = cuts[cuts < len(inside)]
        begins[cuts] = inside[cuts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        before = cuts[cuts > 0] - 1
        ends[before] = inside[before]
        self.inside = inside
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """64 bits for each word; which names one of two independent functions."""
        return hash_ranges(self.data, self.start, self.end, which)

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of each width consecutive words, from the words' hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = np.uint64((0x9E3779B97F4A7C15, 0xD1342543DE82EF95)[which])
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * factor + hashes[k : k + n]
    return mix(total)


def whole_windows(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n windows lie within one row."""
    good = np.ones(max(n, 0), bool)
    for k in first[1:-1]:
        good[max(0, k - width + 1) : k] = False
    return good


def bodies(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each word without the marks around it; one of marks alone starts where it would end, or later."""
    body = np.flatnonzero(~_MARK[words.data])
    if not len(body):
        return words.end, words.end
    return np.append(body, len(words.data))[np.searchsorted(body, words.start)], body[np.maximum(np.searchsorted(body, words.end) - 1, 0)] + 1
