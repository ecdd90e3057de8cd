"""Removal of word sequences that an earlier document has too, by fixed-block anchors.

Documents are dealt to batches of about 4 MB by a hash of id and text.  A repeat of WINDOW = 13 words
holds one whole block of BLOCK = 7 words of its earlier document, as blocks lie at multiples of 7.

1. Every batch settles its own repeats.  Of each distinct window only the document of the smallest id of the
   batch goes on, so a passage that a third of all documents share takes one entry per batch.
2. Anchors: the batches send 47 bits of the hash of every rolling block, with a mark on those that are
   non-overlapping reference blocks.  Hash ranges are probed by themselves: a rolling block that another batch
   indexes is a hit, and so is a reference block that another batch probes.
3. Extension: a hit is extended to both sides to the 13-word windows that hold it.  These meet those of the
   other batches as wholes (96 bits and the smallest id), so a block of many references needs no pairs.
   Extensions that follow each other word by word make up the maximal repeats.
4. Each document drops the words that its repeats cover.

A batch packs its entries of a hash range into one row.  Ranges are as many as batches, so a range takes as much
memory as a batch at any size of input.  Rows number at most batches times ranges and never more than there are
entries; their bytes are in proportion to the input, and no step loops over rows or ranges in Python.

Ids are integers.  Windows are judged on the input, not on what is left.  A null text has no words; an empty one
neither.  Documents with a null id are kept whole and make no repeat; rows with equal ids are no repeats of each
other.  A single text is never split, so the longest one bounds a task's memory from below.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from siftwell.llm.words import Words, rolling, slices, text_bytes

WINDOW, BLOCK = 13, 7
#: Text bytes of a batch, on average.
BATCH_BYTES = 4 << 20
_KEY_BITS = 47
#: With at least as many hash ranges an entry's place in its range takes 40 bits.
LEAST_RANGES = 256


class _Batch:
    """The words of a batch's documents, with the windows that the batch can settle."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.parts: list[Words] = []
        hashes, others, counts = [], [], []
        for part in slices(table.combine_chunks().to_batches(), "text"):
            words = Words(part.column("text"))
            self.parts.append(words)
            hashes.append(words.hashes(0))
            others.append(words.hashes(1))
            counts.append(words.counts)
        hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self._others = np.concatenate([np.zeros(0, np.uint64), *others])
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        n = len(hashes)
        first = np.cumsum(self.counts) - self.counts
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        left = np.repeat(first + self.counts, self.counts) - np.arange(n)  # words from here to the end of the document
        known = np.asarray(table.column("id").is_valid())[self.row] if n else np.zeros(0, bool)
        self.whole = np.flatnonzero((left >= WINDOW) & known)  # where windows start
        self.place = np.arange(n) - np.repeat(first, self.counts)
        windows = rolling(hashes, WINDOW)
        self.keys = windows[self.whole] if len(windows) else np.zeros(0, np.uint64)
        ids = np.asarray(table.column("id").combine_chunks().cast(pa.int64()).fill_null(0))
        self.ids = ids[self.row[self.whole]]
        order = np.argsort(self.keys, kind="stable")
        opens = _opens(self.keys[order])
        self.owner = np.ones(len(self.keys), bool)
        if len(order):
            count = np.diff(np.append(opens, len(order)))
            self.owner[order] = self.ids[order] == np.repeat(np.minimum.reduceat(self.ids[order], opens), count)
        self._hashes = hashes

    def _spread(self, starts: np.ndarray, width: int) -> np.ndarray:
        """Marks on width words from each of the starts."""
        change = np.zeros(len(self.row) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, np.minimum(starts + width, len(self.row)), -1)
        return np.cumsum(change[:-1]) > 0

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct block keys, each doubled and odd where no reference block has it; where blocks start; their keys."""
        starts = np.flatnonzero(self._spread(self.whole[self.owner], WINDOW - BLOCK + 1))
        keys = rolling(self._hashes, BLOCK)[starts] >> np.uint64(64 - _KEY_BITS) if len(starts) else np.zeros(0, np.uint64)
        both = np.sort(keys * np.uint64(2) + (self.place[starts] % BLOCK != 0))
        return both[_opens(both >> np.uint64(1))], starts, keys

    def extensions(self, anchors: tuple[np.ndarray, np.ndarray, np.ndarray], marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys (64 and 32 bits) and ids of the owned windows around a hit.  marks: PROBED and INDEXED on anchors."""
        found, starts, keys = anchors
        mark = marks[np.searchsorted(found >> np.uint64(1), keys)]
        hit = (mark & INDEXED > 0) | ((mark & PROBED > 0) & (self.place[starts] % BLOCK == 0))
        near = np.zeros(len(self.row) + WINDOW, np.int64)
        near[starts[hit]] = 1
        total = np.concatenate([[0], np.cumsum(near)])
        some = self.owner & (total[self.whole + WINDOW - BLOCK + 1] > total[self.whole])
        keys, at = np.unique(self.keys[some], return_index=True)
        wide = rolling(self._others, WINDOW, 1)[self.whole[some][at]] >> np.uint64(32) if len(keys) else keys
        return keys, wide.astype(np.uint32), self.ids[some][at]

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Where windows start that a smaller id has; keys: sorted windows that a smaller id of another batch has."""
        again = ~self.owner
        if len(keys):
            at = np.minimum(np.searchsorted(keys, self.keys), len(keys) - 1)
            again |= keys[at] == self.keys
        return self.whole[again]

    def maximal(self, starts: np.ndarray) -> pa.Array:
        """For each document its maximal repeats: runs of repeated windows, as (first word, word after the last)."""
        row = self.row[starts]
        opens = (np.diff(starts, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0)
        closes = np.append(opens[1:], True)[: len(starts)]
        spans = pa.StructArray.from_arrays([pa.array(self.place[starts[opens]]), pa.array(self.place[starts[closes]] + WINDOW)], ["start", "end"])
        ends = np.cumsum(np.bincount(row[opens], minlength=len(self.counts)))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), spans)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Marks on the words of the windows that start there."""
        return self._spread(starts, WINDOW)


#: Marks on a block's key: another batch has it as a rolling block, or as a reference block.
PROBED, INDEXED = np.uint8(1), np.uint8(2)


def _opens(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _bucket(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """The hash range of each key; larger keys have equal or larger ranges."""
    return (((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _base(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The least key of 48 bits in each hash range."""
    return ((bucket.astype(np.uint64) << np.uint64(32)) + np.uint64(buckets - 1)) // np.uint64(buckets) << np.uint64(16)


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary value for each run of values between neighbouring edges."""
    offsets = (edges * values.itemsize).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
    return found.cast(pa.binary())


def _unpacked(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, one after the other, and how many each row has."""
    data, at = text_bytes(column.combine_chunks())
    size = np.dtype(kind).itemsize
    return data.view(kind), np.diff(at) // size


def _edges(counts: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(counts))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept, repeats): the words left in each document, joined by one space, and its maximal repeats in words."""
    kind = df.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"{id_col} must be an integer column, not {kind.simpleString()}")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = size // batch_bytes + 1
    buckets = max(LEAST_RANGES, batches)
    texts = rows.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(batches)).cast("int"))

    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        found = _Batch(table).anchors()[0]
        bucket = _bucket(found, 48, buckets)
        first = _opens(bucket)
        rest, edges = found - _base(bucket, buckets), np.append(first, len(found))
        batch = np.full(len(first), key[0].as_py(), np.int32)
        return pa.table({"bucket": bucket[first].astype(np.int32), "batch": batch, "high": _packed((rest >> np.uint64(32)).astype(np.uint8), edges), "low": _packed(rest.astype(np.uint32), edges)})

    def probe(table: pa.Table) -> pa.Table:
        bucket = _numbers(table.column("bucket"))
        low, counts = _unpacked(table.column("low"), np.uint32)
        high, _ = _unpacked(table.column("high"), np.uint8)
        found = np.repeat(_base(bucket, buckets), counts) + (high.astype(np.uint64) << np.uint64(32)) + low
        order = np.argsort(found, kind="stable")
        keys, indexed = found[order] >> np.uint64(1), found[order] & np.uint64(1) == 0
        opens = _opens(keys)
        count = np.diff(np.append(opens, len(keys)))
        references = np.repeat(np.add.reduceat(indexed.astype(np.int64), opens), count)
        marks = np.zeros(len(keys), np.uint8)
        marks[order] = np.where(np.repeat(count, count) > 1, PROBED, 0) | np.where(references > indexed, INDEXED, 0)
        some = np.maximum.reduceat(marks, _edges(counts)[:-1]) > 0
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "marks": _packed(marks, _edges(counts))}).filter(pa.array(some))

    def extend(key: tuple, table: pa.Table, hits: pa.Table) -> pa.Table:
        batch = _Batch(table if len(hits) else table.slice(0, 0))
        found = batch.anchors()
        marks = np.zeros(len(found[0]), np.uint8)
        if len(hits):
            bucket = _bucket(found[0], 48, buckets)
            first = _opens(bucket)
            data, counts = _unpacked(hits.column("marks"), np.uint8)
            begin = first[np.searchsorted(bucket[first], _numbers(hits.column("bucket")))]
            marks[np.repeat(begin - _edges(counts)[:-1], counts) + np.arange(len(data))] = data
        keys, wide, ids = batch.extensions(found, marks)
        bucket = _bucket(keys, 64, buckets)
        first = _opens(bucket)
        edges = np.append(first, len(keys))
        number = np.full(len(first), key[0].as_py() if len(first) else 0, np.int32)
        return pa.table({"bucket": bucket[first].astype(np.int32), "batch": number, "keys": _packed(keys, edges), "wide": _packed(wide, edges), "ids": _packed(ids, edges)})

    def compare(table: pa.Table) -> pa.Table:
        keys, counts = _unpacked(table.column("keys"), np.uint64)
        wide, ids = _unpacked(table.column("wide"), np.uint32)[0], _unpacked(table.column("ids"), np.int64)[0]
        order = np.lexsort((ids, wide, keys))
        k, w = keys[order], wide[order]
        opens = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (w[1:] != w[:-1])))
        least = np.repeat(ids[order][opens], np.diff(np.append(opens, len(k))))
        again = np.zeros(len(keys), bool)
        again[order] = least < ids[order]
        counts = np.add.reduceat(again.astype(np.int64), _edges(counts)[:-1])
        return pa.table({"batch": table.column("batch"), "keys": _packed(keys[again], _edges(counts))}).filter(pa.array(counts > 0))

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        batch = _Batch(table)
        starts = batch.repeated(np.sort(_unpacked(found.column("keys"), np.uint64)[0]))
        gone = batch.covered(starts)
        removed = np.bincount(batch.row[gone], minlength=len(batch.counts))
        kept: list[bytes] = []
        at = 0
        for words in batch.parts:
            stays = ~gone[at : at + len(words)]
            at += len(words)
            # the kept words and a space after each
            length = (words.end - words.start) + 1
            take = length[stays]
            ends = np.cumsum(take)
            index = np.repeat(words.start[stays] - (ends - take), take) + np.arange(ends[-1] if len(ends) else 0)
            data = words.data[np.minimum(index, max(0, len(words.data) - 1))].copy() if len(index) else np.zeros(0, np.uint8)
            data[ends - 1] = 0x20
            total = np.concatenate([[0], np.cumsum(np.where(stays, length, 0))])
            raw = data.tobytes()
            kept += [raw[total[a] : max(total[a], total[b] - 1)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        columns = {id_col: batch.table.column("id"), "n_words": batch.counts, "n_removed": removed.astype(np.int64), "kept": pa.array(kept, pa.binary()).cast(pa.string()), "repeats": batch.maximal(starts)}
        return pa.table(columns)

    by_batch = texts.groupBy("batch")
    hits = by_batch.applyInArrow(anchors, "bucket int, batch int, high binary, low binary").groupBy("bucket").applyInArrow(probe, "batch int, bucket int, marks binary")
    windows = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(extend, "bucket int, batch int, keys binary, wide binary, ids binary")
    repeats = windows.groupBy("bucket").applyInArrow(compare, "batch int, keys binary")
    return by_batch.cogroup(repeats.groupBy("batch")).applyInArrow(finish, f"{id_col} {kind.simpleString()}, n_words long, n_removed long, kept string, repeats array<struct<start: long, end: long>>")
