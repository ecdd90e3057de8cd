"""Byte-level BPE by a transducer of frequent words, and its decoding.

The corpus is counted once: its most frequent pre-tokens become a lexicon, whatever its size.  The lexicon is a minimal
acyclic transducer: words that share a beginning share its arcs, the token ids of a word are put out as early as they
are certain, and states with the same arcs, outputs and ends are one, so that words share their endings too.  It is one
file in the shared folder, which Spark brings to every executor and tasks map into memory, all workers of a machine the
same pages.

A slice of texts is cut into pre-tokens by the classes of its code points, all at once; the pre-tokens walk the transducer
in lockstep, one byte a step.  Those that leave it, or end where no word ends, are unseen: the library's own merges encode
each of them, so ids never depend on what the lexicon holds.

A null or empty text has no ids and decodes to the empty text.  Strings of special tokens within a text get the special
id, as the library's default has it.  Repeated rows come out alike; an empty table gives no rows.  A very long text is
held whole in one task, with some 60 bytes for each of its bytes.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.shared import Tables, delete, folder
from siftwell.llm.words import hash_ranges, slices, text_bytes

#: At most so many of the most frequent pre-tokens make up the lexicon, of at most so many bytes each; all others are merged.  Both
#: bound the lexicon, not the result.
LEXICON_WORDS = 1 << 16
LEXICON_BYTES = 32
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 1 << 17
#: Unseen words that a worker remembers, none longer than LEXICON_BYTES * 2.
REMEMBERED = 1 << 16
_OTHER, _LETTER, _NUMBER, _SPACE, _SPECIAL = range(5)


class ByteLevel:
    """A tokenizer file of byte-level BPE: its merges, special tokens and the bytes of each id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        made = json.loads(self.library.to_str())
        split, added = made["pre_tokenizer"], made["added_tokens"]
        if made["model"]["type"] != "BPE" or made["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or made["decoder"]["type"] != "ByteLevel":
            raise ValueError("the tokenizer is no byte-level BPE without normalizer and prefix space")
        if made["model"]["dropout"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] or not t["content"] for t in added):
            raise ValueError("the tokenizer has dropout, or special tokens that take in what is beside them")
        # The byte alphabet: printable Latin-1 characters stand for themselves, other bytes for those from U+0100 on.
        printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        others = [b for b in range(256) if b not in printable]
        self.shown = {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}
        hidden = {shown: b for b, shown in self.shown.items()}
        self.special = {t["content"].encode(): t["id"] for t in added}
        self.bytes_of: list[bytes] = [b""] * (max(self.library.get_vocab(with_added_tokens=True).values(), default=-1) + 1)
        for token, k in self.library.get_vocab(with_added_tokens=False).items():
            self.bytes_of[k] = bytes(hidden[ord(c)] for c in token)
        for token, k in self.special.items():
            self.bytes_of[k] = token

    def merged(self, word: bytes) -> list[int]:
        """The ids of one pre-token, by the library's merges."""
        return [t.id for t in self.library.model.tokenize(word.decode("latin-1").translate(self.shown))]


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """The class of every code point in the library's own regular expressions."""
    from tokenizers import Regex, pre_tokenizers

    found = np.full(0x110000, _OTHER, np.uint8)
    patterns = [(kind, pre_tokenizers.Split(Regex(text), "removed")) for kind, text in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+"))]
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    for block in np.array_split(points, 32):
        text = "".join(map(chr, block.tolist()))
        for kind, split in patterns:
            inside = np.ones(len(block), bool)
            for _, (a, b) in split.pre_tokenize_str(text):
                inside[a:b] = False
            found[block[inside]] = kind
    return found


def pretokens(data: np.ndarray, at: np.ndarray, classes: np.ndarray, special: re.Pattern | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each pre-token of the texts begins, whether it is a special token, and the first pre-token of each text.

    data holds the bytes of all texts, at where each begins.  A contraction is an apostrophe that begins a
    pre-token, with one of its endings; a run of letters, of numbers or of other characters takes one space before it;
    a run of white space leaves its last character to what follows.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(len(at), np.int64)
    buffer = data.tobytes()
    points = np.frombuffer(buffer.decode().encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    kind = classes[points]
    n = len(points)
    edge = np.zeros(n + 1, bool)  # a text or a special token begins or ends before this code point
    edge[np.searchsorted(place, at)] = True
    if special is not None:
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            for hit in special.finditer(buffer, a, b):
                first, then = np.searchsorted(place, hit.span())
                edge[first], edge[then] = True, True
                kind[first:then] = _SPECIAL
    begins = edge.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~edge[1:n])
    begins[last] = True
    begins[last[points[last] == 0x20] + 1] = False
    mark = np.flatnonzero((points == ord("'")) & (kind == _OTHER) & begins[:n])
    behind = np.append(points, [0, 0, 0]).astype(np.int64)
    free = np.append(edge, [True, True])
    one, two = behind[mark + 1], behind[mark + 2]
    short = np.isin(one, [*map(ord, "stmd")]) & ~free[mark + 1]
    pair = one << 21 | two
    long = np.isin(pair, [ord(x) << 21 | ord(y) for x, y in ("re", "ve", "ll")]) & ~free[mark + 1] & ~free[mark + 2]
    begins[mark[short | long] + 1] = False
    begins[mark[short] + 2] = True
    begins[np.minimum(mark[long] + 3, n)] = True
    starts = np.flatnonzero(begins[:n])
    start = place[starts]
    return start, kind[starts] == _SPECIAL, np.searchsorted(start, at)


Arrays = dict[str, np.ndarray]


def transducer(words: list[bytes], ids: list[tuple[int, ...]]) -> Arrays:
    """The minimal acyclic transducer from sorted distinct words to their ids.

    States are made from their ends backwards; one with the same arcs, outputs and end as an earlier one is that one.
    An arc puts out the ids that all words behind it have in common.  Its arrays: bits (which bytes leave a state),
    before (arcs before each quarter of them), target and out of each arc, end of each state (an output, or -1),
    first and pool (the outputs), root.
    """
    states: dict[tuple, int] = {}
    outputs: dict[tuple[int, ...], int] = {(): 0}

    def state(lo: int, hi: int, depth: int, said: int) -> int:
        end = -1
        if lo < hi and len(words[lo]) == depth:
            end = outputs.setdefault(ids[lo][said:], len(outputs))
            lo += 1
        arcs = []
        while lo < hi:
            byte, then = words[lo][depth], lo + 1
            while then < hi and words[then][depth] == byte:
                then += 1
            common = commonprefix([x[said:] for x in ids[lo:then]])
            child = state(lo, then, depth + 1, said + len(common))
            arcs.append((byte, outputs.setdefault(tuple(common), len(outputs)), child))
            lo = then
        return states.setdefault((end, tuple(arcs)), len(states))

    root = state(0, len(words), 0, 0)
    every = list(states)
    bits = np.zeros((len(every), 256), bool)
    arcs = [arc for _, found in every for arc in found]
    owner = np.repeat(np.arange(len(every)), [len(found) for _, found in every])
    byte, out, target = np.array(arcs, np.int64).reshape(-1, 3).T
    bits[owner, byte] = True
    quarter = bits.reshape(-1, 64).sum(1)
    pool = np.array([k for said in outputs for k in said], np.int32)
    return {
        "bits": np.packbits(bits, axis=1, bitorder="little").view(np.uint64), "before": (np.cumsum(quarter) - quarter).reshape(-1, 4), "target": target, "out": out,
        "end": np.array([end for end, _ in every], np.int64), "first": np.cumsum([0, *map(len, outputs)]), "pool": pool, "root": np.array([root]),
    }


def walk(data: np.ndarray, start: np.ndarray, stop: np.ndarray, lexicon: Arrays) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which of the byte ranges are words, and what they put out: (range, step, output)."""
    bits, before, target, out, end = (lexicon[k] for k in ("bits", "before", "target", "out", "end"))
    known = np.zeros(len(start), bool)
    said: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive, state, step = np.arange(len(start)), np.full(len(start), lexicon["root"][0]), 0

    def tell(who: np.ndarray, what: np.ndarray) -> None:
        some = np.flatnonzero(what > 0)
        said.append((who[some], np.full(len(some), step), what[some]))

    while len(alive):
        over = start[alive] + step == stop[alive]
        done, last = alive[over], end[state[over]]
        known[done[last >= 0]] = True
        tell(done, last)
        alive, state = alive[~over], state[~over]
        byte = data[start[alive] + step]
        quarter, bit = byte >> 6, np.uint64(1) << (byte & 63).astype(np.uint64)
        word = bits[state, quarter]
        fits = word & bit != 0
        alive, state = alive[fits], state[fits]
        arc = before[state, quarter[fits]] + np.bitwise_count(word[fits] & (bit[fits] - np.uint64(1)))
        tell(alive, out[arc])
        state = target[arc]
        step += 1
    who, steps, what = (np.concatenate(x) for x in zip(*said, strict=True)) if said else (np.zeros(0, np.int64),) * 3
    good = known[who]
    return known, (who[good], steps[good], what[good])


def packed(arrays: Arrays) -> bytes:
    """Arrays as the content of one file: the length of its head, the head, and each array at a multiple of 64 bytes."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = (x.dtype.str, x.shape, at)
        at += -(-x.nbytes // 64) * 64
    told = json.dumps(head).encode()
    told += b" " * (-(len(told) + 8) % 64)
    return len(told).to_bytes(8, "little") + told + b"".join(x.tobytes().ljust(-(-x.nbytes // 64) * 64, b"\0") for x in arrays.values())


def unpacked(whole: np.ndarray) -> Arrays:
    """The arrays of a packed file, as views of its bytes."""
    size = int.from_bytes(whole[:8].tobytes(), "little")
    head = json.loads(whole[8 : 8 + size].tobytes())
    return {name: np.frombuffer(whole, np.dtype(kind), int(np.prod(shape)), 8 + size + at).reshape(shape) for name, (kind, shape, at) in head.items()}


def share(spark: SparkSession, content: bytes) -> str:
    """The name of a file with that content, which SparkFiles finds on every executor, those that join later included."""
    name = f"siftwell-lexicon-{hashlib.sha256(content).hexdigest()}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    path, part = hadoop.Path(f"{folder(spark)}/{name}"), hadoop.Path(f"{folder(spark)}/{name}.part")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        stream = files.create(part, True)
        stream.write(bytearray(content))
        stream.close()
        files.rename(part, path)
    spark.sparkContext.addFile(path.toString())
    return name


def _special(bpe: ByteLevel) -> re.Pattern | None:
    return re.compile(b"|".join(re.escape(t) for t in sorted(bpe.special, key=len, reverse=True))) if bpe.special else None


def count_words(df: DataFrame, tokenizer_path: str, classes: str, text_col: str = "text", most_bytes: int = LEXICON_BYTES) -> DataFrame:
    """(word, n): how often each pre-token of at most most_bytes stands in all texts.  classes: a shared file of code_point_classes()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, special, counts = _files(classes)["classes"], _special(_byte_level(tokenizer_path)), Counter()

        def told() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return found

        for part in slices(batches, "text"):
            data, at = text_bytes(part.column("text"))
            start, odd, _ = pretokens(data, at, kinds, special)
            stop = np.append(start[1:], len(data))
            fits = ~odd & (stop - start <= most_bytes)
            start, stop = start[fits], stop[fits]
            # words that share a hash by chance are counted as one, which changes the lexicon and no result
            _, seen, n = np.unique(hash_ranges(data, start, stop), return_index=True, return_counts=True)
            buffer = data.tobytes()
            for a, b, k in zip(start[seen].tolist(), stop[seen].tolist(), n.tolist(), strict=True):
                counts[buffer[a:b]] += k
            if len(counts) > COUNTED:
                yield told()
        yield told()

    return df.select(df[text_col].alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame, most_words: int) -> DataFrame:
    """The rows of counted (word, n) of the highest frequencies: whole classes, an eighth of a power of two wide, that hold at most most_words rows together.

    A class is taken or left as a whole, so ties are alike; what comes to the driver is a count for each of a few hundred classes.
    """
    kind = F.floor(F.log2("n") * 8)
    sizes = sorted(((r["kind"], r["rows"]) for r in counted.groupBy(kind.alias("kind")).agg(F.count("*").alias("rows")).collect()), reverse=True)
    least, rows = None, 0
    for k, more in sizes:
        rows += more
        if rows > most_words:
            break
        least = k
    return counted.where(F.lit(False) if least is None else kind >= least)


def build_lexicon(df: DataFrame, tokenizer_path: str, text_col: str = "text", most_words: int = LEXICON_WORDS, most_bytes: int = LEXICON_BYTES) -> str:
    """Count all of df's texts and share the transducer of their most frequent words; the name of its file."""
    tables = Tables(df.sparkSession)
    classes = code_point_classes()
    counted = tables.put(count_words(df, tokenizer_path, share(df.sparkSession, packed({"classes": classes})), text_col, most_bytes))
    words = sorted(bytes(r["word"]) for r in frequent(counted, most_words).select("word").collect())  # most_words * most_bytes at most
    delete(df.sparkSession, tables.root)
    bpe = _byte_level(tokenizer_path)
    return share(df.sparkSession, packed(transducer(words, [tuple(bpe.merged(w)) for w in words]) | {"classes": classes}))


@lru_cache(2)
def _byte_level(path: str) -> ByteLevel:
    """A worker reads a tokenizer file once."""
    return ByteLevel(path)


@lru_cache(4)
def _files(name: str) -> Arrays:
    """A shared file, mapped into memory that all processes of a machine have in common."""
    return unpacked(np.memmap(SparkFiles.get(name), np.uint8, "r"))


class Encoder:
    """Ids of texts by a lexicon, and by merges for what it lacks."""

    def __init__(self, bpe: ByteLevel, lexicon: Arrays):
        self.bpe, self.lexicon, self.special = bpe, lexicon, _special(bpe)
        self.unseen: dict[bytes, list[int]] = {}

    def _merged(self, word: bytes) -> list[int]:
        found = self.unseen.get(word)
        if found is None:
            found = self.bpe.merged(word)
            if len(word) <= 2 * LEXICON_BYTES:
                if len(self.unseen) >= REMEMBERED:
                    self.unseen.clear()
                self.unseen[word] = found
        return found

    def ids(self, column: pa.Array) -> pa.ListArray:
        data, at = text_bytes(column)
        start, odd, first = pretokens(data, at, self.lexicon["classes"], self.special)
        stop = np.append(start[1:], len(data))
        ordinary = np.flatnonzero(~odd)
        known, (who, step, what) = walk(data, start[ordinary], stop[ordinary], self.lexicon)
        seen = np.zeros(len(start), bool)
        seen[ordinary[known]] = True
        buffer = data.tobytes()
        others = np.flatnonzero(~seen)
        spelled = [[self.bpe.special[buffer[a:b]]] if s else self._merged(buffer[a:b]) for a, b, s in zip(start[others].tolist(), stop[others].tolist(), odd[others].tolist(), strict=True)]
        # every piece of output: its pre-token, its step in it, and where its ids are in the pool
        sizes = np.array([len(x) for x in spelled], np.int64)
        pool = np.concatenate([self.lexicon["pool"], np.array([k for x in spelled for k in x], np.int32)])
        begin = np.concatenate([self.lexicon["first"][what], len(self.lexicon["pool"]) + np.cumsum(sizes) - sizes])
        size = np.concatenate([np.diff(self.lexicon["first"])[what], sizes])
        token = np.concatenate([ordinary[who], others])
        order = np.argsort(token * (LEXICON_BYTES + 2) + np.concatenate([step, np.zeros(len(others), np.int64)]), kind="stable")
        begin, size, token = begin[order], size[order], token[order]
        ends = np.cumsum(size)
        values = pool[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        per_token = np.concatenate([[0], ends])[np.searchsorted(token, np.arange(len(start) + 1))]
        return pa.ListArray.from_arrays(pa.array(per_token[first].astype(np.int32)), pa.array(values, pa.int32()))


class Decoder:
    """Texts of ids: the bytes of each id, one after another; bytes that are no text become U+FFFD, ids that don't exist nothing."""

    def __init__(self, bpe: ByteLevel):
        self.size = np.array([len(x) for x in bpe.bytes_of] + [0])
        self.begin = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(bpe.bytes_of), np.uint8)

    def texts(self, lists: pa.ListArray) -> pa.Array:
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        ids = np.where((ids >= 0) & (ids < len(self.size)), ids, len(self.size) - 1)
        width = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(width)])
        data = self.letters[np.repeat(self.begin[ids] - ends[:-1], width) + np.arange(ends[-1])].tobytes()
        count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        first = ends[np.concatenate([[0], np.cumsum(count)])].tolist()
        valid = lists.is_valid().to_pylist()
        return pa.array([data[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(first[:-1], first[1:], valid, strict=True)], pa.string())


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(tokenizer_path: str, lexicon: str, text_col: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_byte_level(tokenizer_path), _files(lexicon))
        for part in slices(batches, text_col):
            yield part.append_column("token_ids", encoder.ids(part.column(text_col)))

    return run


def _decoder(tokenizer_path: str, ids_col: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_byte_level(tokenizer_path))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield part.append_column("decoded", decoder.texts(part.column(ids_col)))

    return run


def encode(df: DataFrame, tokenizer_path: str, lexicon: str | None = None, text_col: str = "text") -> DataFrame:
    """df with a column token_ids, which replaces one of that name.  lexicon: the name that build_lexicon() gave; by default it is built from df."""
    rows = df.drop("token_ids")
    name = lexicon or build_lexicon(df, tokenizer_path, text_col)
    return rows.mapInArrow(_encoder(tokenizer_path, name, text_col), rows.selectExpr("*", "array(0) AS token_ids").schema)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "token_ids") -> DataFrame:
    """df with a column decoded: the text of its ids, null for null; a column decoded of df is replaced."""
    rows = df.drop("decoded")
    return rows.mapInArrow(_decoder(tokenizer_path, ids_col), rows.selectExpr("*", "'' AS decoded").schema)


def round_trip(df: DataFrame, tokenizer_path: str, lexicon: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids, decoded): decode(encode(df)) by one worker for each task; the texts stay behind."""
    name = lexicon or build_lexicon(df, tokenizer_path, text_col)
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    first, then = _encoder(tokenizer_path, name, "text"), _decoder(tokenizer_path, "token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in then(first(batches)):
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("id", "token_ids", "decoded")], names=[id_col, "token_ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, token_ids array<int>, decoded string")
