"""Fill-in-middle: texts cut at two drawn places, and their parts in the order that a model completes.

The library's Split pre-tokenizer isolates every match of a pattern that is one code point, so its offsets are those of
the code points, in order, and no vocabulary is trained.  The length of the offset array is n; the offsets of rank c1 and
c2 cut the text into prefix, middle and suffix.  Code points are isolated whatever stands beside them, so a text goes
through the pre-tokenizer's split in blocks.  The isolated matches of each block are counted, which gives the length of its offset array,
and the two arrays that hold the ranks of the cuts are made: a text takes little more memory than its own, however long it is.

The draws are digits of sha256(seed ":" id), so a row is cut alike wherever and however often it is run.  A null text
counts as empty and stays plain, and so does a text that holds a sentinel.  A null id draws as an empty one; repeated
rows come out alike; an empty table gives no rows.  Columns of df besides id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.words import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points that pass the pre-tokenizer at once.
BLOCK = 128


@lru_cache(1)
def _pattern():
    from tokenizers import Regex

    return Regex(r"(?m:.)")


@lru_cache(1)
def _splitter():
    from tokenizers import pre_tokenizers

    return pre_tokenizers.Split(_pattern(), behavior="isolated")


def offsets(text: str, block: int) -> np.ndarray:
    """Where the code points of one block of the text begin, by the pre-tokenizer."""
    return np.array([at for _, (at, _) in _splitter().pre_tokenize_str(text[block * BLOCK : (block + 1) * BLOCK])], np.int64) + block * BLOCK


def lengths(text: str) -> np.ndarray:
    """How long the offset array of each block is: the isolated matches of the split that the pre-tokenizer makes, which are counted without their texts and offsets."""
    from tokenizers import NormalizedString

    pattern = _pattern()
    return np.array([len(NormalizedString(text[k : k + BLOCK]).split(pattern, "isolated")) for k in range(0, len(text), BLOCK)], np.int64)


def cut(text: str, h1: int, h2: int) -> tuple[int, str, str, str]:
    """n, prefix, middle and suffix; h1 and h2 modulo n + 1 are the ranks of the cuts."""
    before = np.concatenate([[0], np.cumsum(lengths(text))])
    n = int(before[-1])

    def offset(rank: int) -> int:
        if rank == n:
            return len(text)
        block = int(np.searchsorted(before, rank, "right")) - 1
        return int(offsets(text, block)[rank - before[block]])

    first, then = (offset(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    return n, text[:first], text[first:then], text[then:]


def _draws(id_col: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = 90, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of each row of df.

    form is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); fim_percent of the ids are cut, and
    spm_percent of these are spm.  prefix_chars and middle_chars are null where the form is plain, whose output is the text.
    """
    h1, h2, h3, h4 = _draws(df[id_col], seed)
    form = F.when(h3 % 100 >= fim_percent, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sizes, forms, prefixes, middles, outputs = [], [], [], [], []
            for text, h1, h2, form in zip(*(part.column(c).to_pylist() for c in ("text", "h1", "h2", "form")), strict=True):
                text = text or ""
                n, prefix, middle, suffix = cut(text, h1, h2)
                if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                    form = "plain"
                cuts = form != "plain"
                sizes.append(n)
                forms.append(form)
                prefixes.append(len(prefix) if cuts else None)
                middles.append(len(middle) if cuts else None)
                first, then = (PREFIX + prefix, SUFFIX + suffix) if form == "psm" else (SUFFIX + suffix, PREFIX + prefix)
                outputs.append(first + then + MIDDLE + middle if cuts else text)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sizes, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text behind an output.  No part holds a sentinel, so each sentinel is found where it was put."""
    parts = F.array(F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1))  # in a list of one, so that it is split once
    back = F.transform(parts, lambda p: F.when(form == "psm", F.concat(F.get(p, F.lit(1)), F.get(p, F.lit(3)), F.get(p, F.lit(2)))).when(form == "spm", F.concat(F.get(p, F.lit(2)), F.get(p, F.lit(3)), F.get(p, F.lit(1)))))
    return F.when(form == "plain", output).otherwise(F.get(back, F.lit(0)))
