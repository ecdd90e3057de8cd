"""Sampled SentencePiece segmentations, and their decoding.

A text is the concatenation of pre-tokens: a run of spaces with what follows it,
and each control character that no longer piece has.  No piece of a vocabulary crosses such a
border (checked when the model is read), so the piece lattice of a text is the
chain of its pre-tokens' lattices.  Forward filtering runs once per distinct
pre-token: alpha[j] sums the weights of all segmentations of the first j
characters, and each arc ending at j keeps its share of alpha[j].  Backward
sampling then draws one arc after the other from the end of every pre-token, all
occurrences of a batch in lockstep.  The draws come from a counter-based
generator keyed by the row's key, the pre-token's place and the step, so a row
gets the same segmentation wherever and however often it is run.

A piece of rank r weighs (r + 2) ** -alpha, as the ranks of a BPE vocabulary
carry no probabilities of their own.  Characters without a piece fall back to
the pieces of their UTF-8 bytes, and so does a literal U+2581, which the model
uses for a space; decoding therefore gives back every text exactly.

A null or empty text has no pieces, and decodes to the empty text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwell.llm.words import hash_ranges, letters, mix, slices, text_bytes

SPACE = "\u2581"
#: Codes from here on are characters that fall back to bytes: their UTF-8 bytes, the first one lowest.
_FALLBACK = 1 << 40
#: Lattice slots that a task remembers between batches.
LATTICE_SLOTS = 1 << 20
_DRAW_BITS = 30
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(2)
def piece_model(model_path: str, alpha: float) -> PieceModel:
    """A worker reads a model once."""
    return PieceModel(model_path, alpha)


class PieceModel:
    """The pieces of a SentencePiece model file, and a table of their prefixes with code and log weight."""

    def __init__(self, model_path: str, alpha: float):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        if sum(model.is_byte(k) for k in range(model.vocab_size())) != 256:
            raise ValueError("the model has no pieces for all bytes, so some texts would not come back")
        self.bytes_of = [b""] * model.vocab_size()
        self.byte_ids = np.zeros(256, np.int64)
        weight: dict[bytes, tuple[int, float]] = {}
        for k in range(model.vocab_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_ids[int(piece[3:5], 16)] = k
                self.bytes_of[k] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} crosses the border of a pre-token")
                self.bytes_of[k] = piece.replace(SPACE, " ").encode()
                weight[self.bytes_of[k]] = (k, -alpha * math.log(2.0 - model.get_score(k)))
        #: Control characters that are part of no longer piece: each is a pre-token of its own.
        self.alone = [c for c in range(0x09, 0x0E) if not any(c in piece for piece in weight if len(piece) > 1)]
        self.least = min(w for _, w in weight.values()) - 7.0
        codes = letters().tolist()
        table: dict[int, tuple[int, float]] = {}
        for piece, (code, log_weight) in weight.items():
            h = 0
            for k, byte in enumerate(piece):
                h = (h * int(_FACTOR) + codes[byte]) % 2**64
                table.setdefault(h, (-1, 0.0))
                if k == len(piece) - 1:
                    table[h] = (code, log_weight)
        self.keys = np.array(sorted(table), np.uint64)
        self.codes = np.array([table[k][0] for k in self.keys.tolist()], np.int64)
        self.log_weights = np.array([table[k][1] for k in self.keys.tolist()])
        top = (self.keys >> np.uint64(44)).astype(np.int64)
        self._at = np.searchsorted(top, np.arange(1 << 20)).astype(np.int32)
        self._most = int(np.bincount(top).max())

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are prefixes of pieces, and where these are in keys."""
        at = np.minimum(self._at[(h >> np.uint64(44)).astype(np.int64)], len(self.keys) - 1)
        good = self.keys[at] == h
        for k in range(1, self._most):
            bad = np.flatnonzero(~good)
            later = np.minimum(at[bad] + k, len(self.keys) - 1)
            hit = self.keys[later] == h[bad]
            at[bad[hit]], good[bad[hit]] = later[hit], True
        return good, at[good]


def _arcs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, model: PieceModel) -> tuple[np.ndarray, ...]:
    """(first byte, byte after, code, log weight) of every piece in data that lies within one pre-token."""
    limit = np.repeat(end, end - begin)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    width = np.diff(np.append(chars, len(data)))
    codes = letters()
    alive, h, length = chars, np.zeros(len(chars), np.uint64), 0
    single = np.zeros(len(data), bool)
    wide = np.zeros(len(data), np.int64)
    wide[chars] = width
    found: list[tuple[np.ndarray, ...]] = []
    while len(alive):
        length += 1
        fits = alive + length <= limit[alive]
        alive, h = alive[fits], h[fits]
        h = h * _FACTOR + codes[data[alive + (length - 1)]]
        known, at = model.look_up(h)
        alive, h = alive[known], h[known]
        code = model.codes[at]
        hit = code >= 0
        start = alive[hit]
        single[start[wide[start] == length]] = True
        found.append((start, start + length, code[hit], model.log_weights[at[hit]]))
    alone = chars[~single[chars]]
    spelled = np.zeros(len(alone), np.int64)
    for k in range(4):
        more = wide[alone] > k
        spelled[more] |= data[alone[more] + k].astype(np.int64) << (8 * k)
    found.append((alone, alone + wide[alone], spelled + _FALLBACK, np.full(len(alone), model.least)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _filtered(data: np.ndarray, begin: np.ndarray, end: np.ndarray, model: PieceModel) -> tuple[np.ndarray, ...]:
    """Forward filtering of all pre-tokens at once.

    Slots are the positions of a pre-token, its end included.  Returns the arcs sorted by the
    slot they end in (code, slot they start in or -1 at the beginning, slot plus cumulative share of
    the slot's total weight) and the last slot of each pre-token.
    """
    start, stop, code, log_weight = _arcs(data, begin, end, model)
    which = np.repeat(np.arange(len(begin)), end - begin)[start]
    place = start - begin[which]
    order = np.argsort(place.astype(np.uint16) if place.max(initial=0) < 1 << 16 else place, kind="stable")
    place, which = place[order], which[order]
    source, target, code, log_weight = start[order] + which, stop[order] + which, code[order], log_weight[order]
    total = np.full(len(data) + len(begin), -np.inf)
    total[begin + np.arange(len(begin))] = 0.0
    borders = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
    for a, b in zip(borders[:-1], borders[1:], strict=True):  # arcs from one place end in different slots
        total[target[a:b]] = np.logaddexp(total[target[a:b]], total[source[a:b]] + log_weight[a:b])
    share = np.exp(total[source] + log_weight - total[target])
    order = np.argsort(target, kind="stable")
    code, target, share = code[order], target[order], share[order]
    previous = np.where(place[order] == 0, -1, source[order])
    summed = np.cumsum(share)
    last = np.flatnonzero(np.diff(target, append=-1))
    before = np.concatenate([[0.0], summed[last[:-1]]])
    summed = np.clip(summed - np.repeat(before, np.diff(last, prepend=-1)), 0.0, 1.0)
    summed[last] = 1.0
    return code, previous, target + summed, end + np.arange(len(begin))


class Lattices:
    """Filtered lattices of the pre-tokens that a task has met, by the pre-token's hash."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.keys, self.finals, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        self.arrays = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]

    def find(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The final slots of distinct pre-tokens: sorted keys, and the bytes of each in data."""
        if self.slots > LATTICE_SLOTS:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            length = (end - begin)[new]
            ends = np.cumsum(length)
            picked = data[np.repeat(begin[new] - ends + length, length) + np.arange(ends[-1])]
            code, previous, share, final = _filtered(picked, ends - length, ends, self.model)
            previous[previous >= 0] += self.slots
            self.arrays = [np.concatenate(x) for x in zip(self.arrays, (code, previous, share + self.slots), strict=True)]
            both, finals = np.concatenate([self.keys, keys[new]]), np.concatenate([self.finals, final + self.slots])
            order = np.argsort(both, kind="stable")
            self.keys, self.finals = both[order], finals[order]
            self.slots += len(picked) + len(new)
        return self.finals[np.searchsorted(self.keys, keys)]


def _pretokens(column: pa.Array, alone: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space before each text that isn't empty; where pre-tokens begin; the first pre-token of each row."""
    data, at = text_bytes(column)
    filled = np.diff(at) > 0
    out = np.full(len(data) + int(filled.sum()), 0x20, np.uint8)
    shift = np.cumsum(filled)
    rows = np.repeat(np.arange(len(filled)), np.diff(at))
    out[np.arange(len(data)) + shift[rows]] = data
    at = at + np.concatenate([[0], shift])
    space, control = out == 0x20, np.isin(out, alone)
    begins = np.ones(len(out), bool)
    begins[1:] = (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
    begins[at[:-1][filled]] = True
    start = np.flatnonzero(begins)
    return out, start, np.searchsorted(start, at)


def _sample(finals: np.ndarray, seeds: np.ndarray, arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of one sampled path per final node, in text order, and the number of each."""
    code, previous, share = arrays
    length = np.zeros(len(finals), np.int64)
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    alive = np.argsort(finals, kind="stable")  # equal pre-tokens together: their arcs are near each other
    node, step = finals[alive], 0
    while len(alive):
        draw = mix(seeds[alive] + np.uint64(step * 0x9E3779B97F4A7C15 & 2**64 - 1)) >> np.uint64(64 - _DRAW_BITS)
        arc = np.searchsorted(share, node + draw.astype(np.float64) * 2.0**-_DRAW_BITS, "right")
        taken.append((alive, code[arc]))
        length[alive] += 1
        node = previous[arc]
        more = node >= 0
        alive, node, step = alive[more], node[more], step + 1
    last = np.cumsum(length) - 1
    out = np.zeros(int(length.sum()), np.int64)
    for step, (who, codes) in enumerate(taken):
        out[last[who] - step] = codes
    return out, length


def _to_bytes(codes: np.ndarray, length: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace codes of characters by the ids of their bytes; length: codes of each group."""
    odd = np.flatnonzero(codes >= _FALLBACK)
    if not len(odd):
        return codes.astype(np.int32), length
    spelled = codes[odd] - _FALLBACK
    lead = spelled & 0xFF
    width = np.ones(len(codes), np.int64)
    width[odd] = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    out = np.repeat(codes, width)
    at = np.cumsum(width) - width
    for k in range(4):
        some = width[odd] > k
        out[at[odd[some]] + k] = byte_ids[(spelled[some] >> (8 * k)) & 0xFF]
    total = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(width, out=total[1:])
    ends = np.cumsum(length)
    return out.astype(np.int32), total[ends] - total[ends - length]


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """df with a column piece_ids: one sampled segmentation per row, seeded by the row's id and seed.

    Rows with equal ids and texts get equal pieces; a null id is a key like any other.  A column piece_ids of df is
    replaced.
    """
    rows = _with_key(df, id_col)
    return rows.mapInArrow(_encoder(model_path, text_col, rows.columns, alpha, seed), _encoded_schema(df))


def _with_key(df: DataFrame, id_col: str) -> DataFrame:
    """df with piece_ids: the row's key, until the pieces are there."""
    return df.drop("piece_ids").withColumn("piece_ids", F.xxhash64(df[id_col]))


def _encoded_schema(df: DataFrame) -> StructType:
    return df.drop("piece_ids").withColumn("piece_ids", F.array(F.lit(0))).schema


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(model_path: str, text_col: str, names: list[str], alpha: float, seed: int) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, alpha)
        lattices = Lattices(model)
        for part in slices(batches, text_col):
            data, start, first = _pretokens(part.column(text_col), model.alone)
            ends = np.append(start[1:], len(data))
            keys, seen_at, which = np.unique(hash_ranges(data, start, ends), return_index=True, return_inverse=True)
            final = lattices.find(keys, data, start[seen_at], ends[seen_at])
            counts = np.diff(first)
            row_key = np.repeat(part.column("piece_ids").to_numpy(zero_copy_only=False).view(np.uint64), counts)
            place = np.arange(len(start)) - np.repeat(first[:-1], counts)
            codes, length = _sample(final[which], mix(row_key ^ mix(place.astype(np.uint64) + np.uint64(seed + 1))), lattices.arrays)
            ids, length = _to_bytes(codes, length, model.byte_ids)
            total = np.concatenate([[0], np.cumsum(length)])
            lists = pa.ListArray.from_arrays(pa.array(total[first].astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=names)

    return run


def decode(df: DataFrame, model_path: str, pieces_col: str = "piece_ids") -> DataFrame:
    """df with a column decoded: the text of its pieces.  Null pieces decode to null; a column decoded of df is replaced."""
    df = df.drop("decoded")
    return df.mapInArrow(_decoder(model_path, pieces_col), df.selectExpr("*", "'' AS decoded").schema)


def round_trip(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """decode(encode(df)) by one worker for each task."""
    rows = _with_key(df.drop("decoded"), id_col)
    first, then = _encoder(model_path, text_col, rows.columns, alpha, seed), _decoder(model_path, "piece_ids", alpha)
    schema = _encoded_schema(df.drop("decoded")).add("decoded", "string")
    return rows.mapInArrow(lambda batches: then(first(batches)), schema)


def _decoder(model_path: str, pieces_col: str, alpha: float = 1.0) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = piece_model(model_path, alpha).bytes_of
        size = np.array([len(x) for x in spelled])
        begin = np.cumsum(size) - size
        spelled_out = np.frombuffer(b"".join(spelled), np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(pieces_col)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                width = size[ids]
                ends = np.concatenate([[0], np.cumsum(width)])
                data = spelled_out[np.repeat(begin[ids] - ends[:-1], width) + np.arange(ends[-1])].tobytes()
                first = ends[np.concatenate([[0], np.cumsum(count)])]
                texts = [data[a + 1 : b].decode("utf-8") for a, b in zip(first[:-1], first[1:], strict=True)]  # without the space before
                decoded = pa.array([t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return run
