"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query of trigrams that
every match must contain (of the lower-cased text).  Texts are indexed in blocks
that stay within their task: postings list the rows of a block for every trigram
that some rule asks for.  Evaluating a rule's query by intersection and union of
postings gives its candidates, and only these are verified with the expression.
A rule without mandatory trigrams, such as a run of hexadecimal digits, scans
every row of the block.  No row leaves its partition.

A null text counts as empty.  Spans are code points of the text, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.words import LOWER, slices, text_bytes

#: Literal alternatives that are followed at once before their trigrams are taken.
_MOST_STRINGS = 64


class Query:
    """A Boolean query: every one, or any one, of trigrams and further queries.  all with no parts is always true."""

    def __init__(self, every: bool, parts: frozenset):
        self.every, self.parts = every, parts

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Query) and (self.every, self.parts) == (other.every, other.parts)

    def __hash__(self) -> int:
        return hash((self.every, self.parts))

    @property
    def always(self) -> bool:
        return self.every and not self.parts

    def trigrams(self) -> set[bytes]:
        return {t for p in self.parts for t in (p.trigrams() if isinstance(p, Query) else {p})}

    def rows(self, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        """Rows of a block of n that satisfy the query."""
        if self.always:
            return np.arange(n)
        lists = sorted((p.rows(postings, n) if isinstance(p, Query) else postings.get(p, np.zeros(0, np.int64)) for p in self.parts), key=len)
        found = lists[0]
        for more in lists[1:]:
            found = np.intersect1d(found, more, assume_unique=True) if self.every else np.union1d(found, more)
        return found


ALWAYS = Query(True, frozenset())


def every(queries: list[Query]) -> Query:
    parts = frozenset(x for q in queries for x in (q.parts if q.every else [q]))
    return next(iter(parts)) if len(parts) == 1 and isinstance(next(iter(parts)), Query) else Query(True, parts)


def any_of(queries: list[Query]) -> Query:
    if any(q.always for q in queries):
        return ALWAYS
    parts = frozenset(queries)
    return next(iter(parts)) if len(parts) == 1 else Query(False, parts)


def _of_strings(strings: set[str]) -> Query:
    spelled = [s.encode() for s in strings]
    return any_of([Query(True, frozenset(s[k : k + 3] for k in range(len(s) - 2))) for s in spelled]) if spelled else ALWAYS


def _class(items: list) -> set[str] | None:
    """The characters of a class, or None if they are many or not listed."""
    found: set[str] = set()
    for op, arg in items:
        if op is parser.LITERAL:
            found.add(chr(arg))
        elif op is parser.RANGE and arg[1] - arg[0] < 16:
            found |= set(map(chr, range(arg[0], arg[1] + 1)))
        else:
            return None
    return {c.lower() for c in found} if len(found) <= 16 else None


def _analysed(sequence) -> tuple[set[str] | None, Query]:
    """All strings that a parsed expression matches, if few, and a query that its matches satisfy."""
    exact, queries, whole = {""}, [], True

    def flush() -> None:
        nonlocal exact, whole
        queries.append(_of_strings(exact))
        exact, whole = {""}, False

    for op, arg in sequence:
        strings, query = None, ALWAYS
        if op is parser.LITERAL:
            strings = {chr(arg).lower()}
        elif op is parser.IN:
            strings = _class(arg)
        elif op is parser.AT:
            strings = {""}
        elif op is parser.SUBPATTERN:
            strings, query = _analysed(arg[-1])
        elif op is parser.BRANCH:
            branches = [_analysed(x) for x in arg[1]]
            strings = set().union(*(s for s, _ in branches)) if all(s is not None for s, _ in branches) else None
            query = any_of([q if s is None else _of_strings(s) for s, q in branches])
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT, parser.POSSESSIVE_REPEAT):
            low, high, body = arg
            inner, query = _analysed(body)
            if inner is not None and high <= 2 and len(inner) ** high <= _MOST_STRINGS:
                strings = {"".join(x) for n in range(low, high + 1) for x in product(inner, repeat=n)}
            elif inner is not None and low and len(exact) * len(inner) ** min(low, 3) <= _MOST_STRINGS:
                exact = {a + "".join(x) for a in exact for x in product(inner, repeat=min(low, 3))}
            query = query if low and strings is None else ALWAYS
        if strings is None or len(exact) * len(strings) > _MOST_STRINGS:
            flush()
            queries.append(_of_strings(strings) if strings is not None else query)
        else:
            exact = {a + b for a in exact for b in strings}
    return (exact, _of_strings(exact)) if whole else (None, every([*queries, _of_strings(exact)]))


def trigram_query(pattern: str) -> Query:
    """Trigrams of lower-cased text that every match of the expression has, as a Boolean query."""
    strings, query = _analysed(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern that passes accepts; others are dropped without another try."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    accepts: Callable[[re.Match], bool] = lambda m: True
    query: Query = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "query", trigram_query(self.pattern))
        object.__setattr__(self, "compiled", re.compile(self.pattern, self.flags))


_KEY_NAME = "(?:[A-Z]+ ){0,3}PRIVATE KEY-----"
BASE_KINDS = ["assign", "access", "hex"]
RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, lambda m: len(m[2]) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", accepts=lambda m: len(m[0]) >= 18),
    Rule("hex", r"[0-9a-f]{16,}"),
    # To the line that ends the key, or else over the lines of its code.
    Rule("private_key", rf"-----BEGIN {_KEY_NAME}(?:[^-]*(?:-(?!----)[^-]*)*-----END {_KEY_NAME}|(?:\s+[A-Za-z0-9+/=]{{16,}})*)"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"bearer\x20[A-Za-z0-9._~+/-]{20,}", re.ASCII | re.IGNORECASE),
    Rule("url_password", r"://[^\s:/@]+:[^\s:/@]{3,}@"),
]


class Index:
    """Postings of the rules' trigrams, block by block."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        grams = sorted(set().union(*(r.query.trigrams() for r in rules)))
        self.codes = np.array([int.from_bytes(g, "big") for g in grams], np.int64)
        self.grams = grams
        self.asked = np.zeros(1 << 24, bool)
        self.asked[self.codes] = True

    def postings(self, column: pa.Array) -> dict[bytes, np.ndarray]:
        """For each asked trigram that occurs, the sorted rows that have it."""
        data, at = text_bytes(column)
        if len(data) < 3:
            return {}
        low = LOWER[data].astype(np.int32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        place = np.flatnonzero(self.asked[codes])
        row = np.searchsorted(at, place, "right") - 1
        within = place + 3 <= at[row + 1]
        both = np.unique(np.searchsorted(self.codes, codes[place[within]]) * len(column) + row[within])
        gram, row = np.divmod(both, len(column))
        cuts = np.searchsorted(gram, np.arange(len(self.grams) + 1))
        return {g: row[a:b] for g, a, b in zip(self.grams, cuts[:-1], cuts[1:], strict=True) if a < b}

    def spans(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of every accepted match of each row, sorted."""
        postings, n = self.postings(column), len(column)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        texts: dict[int, str] = dict(enumerate(column.to_pylist())) if any(r.query.always for r in self.rules) else {}
        for k, rule in enumerate(self.rules):
            for row in rule.query.rows(postings, n).tolist():
                text = texts[row] if row in texts else texts.setdefault(row, column[row].as_py())
                if text:
                    found[row] += [(m.start(), k, m.end()) for m in rule.compiled.finditer(text) if rule.accepts(m)]
        for spans in found:
            spans.sort()
        return found


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(id, spans): the secrets of each row as array<struct<kind, start, end>>, by start, then in the order of the rules."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, spans array<struct<kind:string,start:int,end:int>>"
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for part in slices(batches, "text"):
            spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in row] for row in index.spans(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(spans, struct)], names=[id_col, "spans"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, schema)


def redact(df: DataFrame, text_col: str = "text", n_chars_col: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """df with every secret replaced by its kind in brackets, overlapping ones as one; n_chars_col is counted anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for part in slices(batches, text_col):
            column = part.column(text_col)
            spans = index.spans(column)
            if any(spans):
                texts = column.to_pylist()
                for row, found in enumerate(spans):
                    if found:
                        out, last = [], 0
                        for start, k, end in found:
                            if start >= last:
                                out += [texts[row][last:start], f"[{rules[k].kind}]"]
                            last = max(last, end)
                        texts[row] = "".join([*out, texts[row][last:]])
                part = part.set_column(part.schema.get_field_index(text_col), part.schema.field(text_col), pa.array(texts, column.type))
                if n_chars_col:
                    at = part.schema.get_field_index(n_chars_col)
                    counts = [len(t) if spans[row] else n for row, (t, n) in enumerate(zip(texts, part.column(at).to_pylist(), strict=True))]
                    part = part.set_column(at, part.schema.field(at), pa.array(counts, part.schema.field(at).type))
            yield part

    return df.mapInArrow(run, df.schema)
