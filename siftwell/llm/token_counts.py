"""Token counts from the frequencies of pre-tokens.

The tokenizer drops white space and never joins what it separates (checked when
its file is read).  So the tokens of a text are those of its chunks between white
space, and those of a chunk are those of the tokenizer's own pre-tokens in it.
Within a task there are three relations:

* pieces(pre-token, n): every distinct pre-token is split into pieces once;
* chunks(chunk, n): the pieces of each distinct chunk, summed over its pre-tokens;
* frequencies(row, chunk, n): how often a chunk is in a document.

frequencies joined with chunks and summed by row gives the counts; token ids are
not kept.  The join stays within a task: its dictionaries are bounded, and no row
leaves the partition it was read in, so skew of sources or of frequent words
moves nothing (a shuffle of all frequencies would write several times the input).

A null or empty text has 0 bytes and 0 tokens; repeated rows are counted alike; a
very long text is held whole in one task, with some 50 bytes for each of its bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.words import Words, slices

#: Distinct chunks and pre-tokens that a task remembers between batches; a full memory is emptied.
DICTIONARY_ENTRIES = 1_000_000
PRETOKEN_ENTRIES = 100_000
_PROBES = ["a", "Zq", "12", "it's", "x,", "(", "\u00e9", "\u4f60\u597d"]
_SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "  ", "\r\n"]


class PieceCounts:
    """Piece counts of chunks, each distinct pre-token of them split once."""

    def __init__(self, tokenizer_path: str, entries: int = DICTIONARY_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._check()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.entries = entries
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.pieces: dict[str, int] = {}

    def _check(self) -> None:
        """White space must be dropped and change nothing in what it separates."""
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            raise ValueError("the tokenizer has no normalizer or no pre-tokenizer")
        ids = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in _PROBES]
        for space in _SPACES:
            whole = self.tokenizer.encode(space + space.join(_PROBES) + space, add_special_tokens=False).ids
            if whole != [k for x in ids for k in x]:
                raise ValueError(f"the tokenizer does not drop the white space {space!r}")

    def _pretoken(self, text: str) -> int:
        found = self.pieces.get(text)
        if found is None:
            if len(self.pieces) >= PRETOKEN_ENTRIES:
                self.pieces.clear()
            found = self.pieces[text] = len(self.tokenizer.model.tokenize(text))
        return found

    def _chunk(self, text: str) -> int:
        if any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(self._pretoken(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text)))

    def _looked_up(self, words: Words, keys: np.ndarray, seen_at: np.ndarray) -> np.ndarray:
        """chunks: the pieces of each of the distinct chunks."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        counts = np.zeros(len(keys), np.int64)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        counts[new] = [self._chunk(words.text(k).decode("utf-8", "replace")) for k in seen_at[new]]
        if len(self.keys) + len(new) > self.entries:
            self.keys, self.counts = keys, counts
        elif len(new):
            keys, both = np.concatenate([self.keys, keys[new]]), np.concatenate([self.counts, counts[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.counts = keys[order], both[order]
        return counts

    def per_row(self, words: Words) -> np.ndarray:
        """Tokens of each row: the frequencies of its chunks joined with their pieces, and summed."""
        keys, seen_at, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        pieces = self._looked_up(words, keys, seen_at)
        pair, times = np.unique(words.rows * max(1, len(keys)) + which, return_counts=True)
        row, chunk = np.divmod(pair, max(1, len(keys)))
        total = np.zeros(len(words.first) - 1, np.int64)
        np.add.at(total, row, times * pieces[chunk])
        return total


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of df, as the tokenizer file's library counts them.

    No begin, end or padding tokens and no truncation; special strings inside a text count
    as the library's default.  Repeated ids give repeated rows; an empty table gives none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceCounts(tokenizer_path)
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            tokens = pieces.per_row(words)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(words.offsets)), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(count, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean")
