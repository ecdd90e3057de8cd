"""Personal data by patterns and a semi-Markov conditional random field.

The patterns give the base spans.  The field adds spans: the words around digits
and @ form islands, and a labelling of an island is a sequence of segments, each
with a type.  Features look at a whole candidate segment (its numbers of digits,
letters and marks, Luhn's check, octets, the word before it, how many words it
joins), so they can tell a card number of four groups from four numbers.  A
segment that is personal data has at most MOST_WORDS words; dynamic programming
over all such segments picks boundaries and types together.  Weights maximise the
conditional likelihood of labelled islands that are made here from a fixed seed.

A null text counts as empty.  Spans are code points of the text, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.words import slices, text_bytes

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "ssn", "iban"]
#: The most words of a segment that is personal data: an IBAN of 34 characters in groups of four has nine.
MOST_WORDS = 9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the patterns' matches: leftmost, without overlap per kind, failing ones dropped."""
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x) <= 3 and int(x or 0) <= 255 for x in (p.lstrip("0") for p in m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return found


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NARROW = re.compile(r"[\x20\t]{1,2}")
#: Words whose segments are scored at once.
BLOCK = 512
_TRIM = " \t.,;:!?\"'<>[]{}|*#$%&=_/\\"
_CUES = {"email": "mail email e-mail contact", "ip": "ip host address server", "card": "card visa credit payment", "phone": "phone tel call mobile fax", "ssn": "ssn social security", "iban": "iban account bank"}
_CUE = {w: k for k, words in enumerate(_CUES.values()) for w in words.split()}
_PLAIN, _PHONE_MARKS = frozenset("0123456789 -"), frozenset("+().")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}")


def features(segment: str, words: int, before: str) -> np.ndarray:
    """What a whole segment looks like."""
    body = segment.strip(_TRIM)
    digits = "".join(_DIGITS.findall(body))
    n, joined = len(digits), body.replace(" ", "")
    letters = sum(c.isalpha() for c in body)
    octets = body.split(".")
    four = len(octets) == 4 and all(x.isascii() and x.isdigit() for x in octets)
    local, _, domain = body.partition("@")
    cue = _CUE.get(before.strip(_TRIM).lower(), -1)
    return np.array(
        [
            1.0, words > 1, words > 2, words > 4, n == 0, 1 <= n < 8, 8 <= n <= 15, 16 <= n <= 19, n > 19, letters == 0, letters > 0 and n > 0,
            body.count("@") == 1 and bool(local) and bool(_DOMAIN.fullmatch(domain)), "@" in body, body.count("@") > 1,
            four, four and all(len(x) <= 3 and int(x) <= 255 for x in octets), body.count(".") > 3,
            16 <= n <= 19 and luhn(digits), 16 <= n <= 19 and not luhn(digits), body.startswith("+"), body.startswith("+") and 8 <= n <= 15 and letters == 0,
            body.count("(") == body.count(")") == 1, "(" in body or ")" in body, bool(_SSN.fullmatch(body)), bool(_IBAN.fullmatch(joined)), body.count("-") == 2,
            " " in body and "@" in body, not (set(body) - _PLAIN), n >= 8 and bool(set(body) - _PLAIN - _PHONE_MARKS), *(cue == k for k in range(len(_CUES))),
        ],
        dtype=float,
    )


def islands(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words with digits or @, with one or two blanks between: the words of each.  Every character is looked at a few times, however long a word is."""
    run: list[tuple[int, int]] = []
    last, sign = 0, _SIGN.search(text)
    while sign:
        start = max(text.rfind(c, last, sign.start()) for c in " \t\n\x0b\x0c\r") + 1
        start = max(start, last)
        space = _SPACE.search(text, sign.end())
        end = space.start() if space else len(text)
        if run and not _NARROW.fullmatch(text, run[-1][1], start):
            yield run
            run = []
        run.append((start, end))
        last, sign = end, _SIGN.search(text, end)
    if run:
        yield run


def _segments(text: str, spans: list[tuple[int, int]], before: str, first: int = 0, stop: int | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Features of all segments of at most MOST_WORDS words that end with the words from first to stop, and their first and last word."""
    rows, places = [], []
    for end in range(first, len(spans) if stop is None else stop):
        for begin in range(max(0, end - MOST_WORDS + 1), end + 1):
            previous = text[spans[begin - 1][0] : spans[begin - 1][1]] if begin else before
            rows.append(features(text[spans[begin][0] : spans[end][1]], end - begin + 1, previous))
            places.append((begin, end))
    return np.array(rows), places


def _made_islands(rng: np.random.Generator, count: int) -> Iterator[tuple[str, str, list[tuple[int, int, int]]]]:
    """(text, word before, segments as label, first and last word): label 0 is nothing."""

    def number(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def card() -> str:
        body = number(15)
        last = next(d for d in "0123456789" if luhn(body + d))
        return body + last

    def entity(kind: int) -> str:
        if kind == 0:
            return f"{''.join(rng.choice(list('abcdefghij'), 5))}{rng.choice(['', '.', '_'])}{number(2)}@{rng.choice(['mail', 'post', 'site'])}{number(1)}.{rng.choice(['example.com', 'org', 'net'])}"
        if kind == 1:
            return ".".join(map(str, rng.integers(0, 256, 4)))
        if kind == 2:
            digits, gap = card(), rng.choice(["", " ", "-"])
            return gap.join(digits[k : k + 4] for k in range(0, 16, 4))
        if kind == 3:
            return rng.choice([f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(3)} {number(3)}", f"{number(3)}-{number(3)}-{number(4)}"])
        if kind == 4:
            return f"{number(3)}-{number(2)}-{number(4)}"
        length = int(rng.choice([15, 16, 18, 20, 22, 22, 24, 27, 28, 29, 31, 34]))
        whole = f"{rng.choice(['DE', 'FR', 'GB', 'NO', 'MT'])}{number(length - 2)}"
        return " ".join(whole[k : k + 4] for k in range(0, length, 4)) if rng.random() < 0.6 else whole

    def noise() -> str:
        return str(rng.choice([number(1), number(2), number(4), number(8), number(12), number(16), f"{number(2)}.{number(2)}", f"v{number(1)}.{number(1)}.{number(1)}", f"{number(4)}-{number(2)}-{number(2)}", f"a{number(3)}", f"x@{number(2)}", f"@user{number(2)}", f"{number(3)},{number(3)}", f"{number(20)}", f"{number(24)}ab"]))

    for _ in range(count):
        words, labels = [], []
        for _ in range(rng.integers(1, 4)):
            kind = int(rng.integers(-4, len(KINDS)))
            text = noise() if kind < 0 else entity(kind)
            parts = text.split(" ")
            labels += [(0, len(words), len(words))] if kind < 0 else [(kind + 1, len(words), len(words) + len(parts) - 1)]
            parts[-1] += str(rng.choice(["", "", ".", ",", ";"]))
            words += parts
        cue = labels[0][0]
        before = str(rng.choice(list(_CUES.values())[cue - 1].split())) if cue and rng.random() < 0.4 else str(rng.choice(["the", "of", "and", "was", ""]))
        yield " ".join(words), before, labels


@lru_cache(1)
def trained(islands: int = 300, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(weights by feature and label, weights by label and next label), fitted to made islands; bounds are parameters."""
    rng = np.random.default_rng(17)
    data = []
    for text, before, labels in _made_islands(rng, islands):
        rows, places = _segments(text, [m.span() for m in _WORD.finditer(text)], before)
        data.append((rows, places, {(a, b): y for y, a, b in labels}))
    size = len(KINDS) + 1
    weights, moves = np.zeros((data[0][0].shape[1], size)), np.zeros((size, size))
    squares = [np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)]
    for _ in range(steps):
        grad, grad_moves = 1e-3 * len(data) * weights, 1e-3 * len(data) * moves
        for rows, places, gold in data:
            scores = _scores(rows, places, weights)
            n = places[-1][1] + 1
            ahead, behind = np.full((n + 1, size), -np.inf), np.full((n + 1, size), -np.inf)
            ahead[0, 0] = 0.0  # before the island nothing stands
            for k, (a, b) in enumerate(places):
                into = np.logaddexp.reduce(ahead[a][:, None] + moves, 0) + scores[k]
                ahead[b + 1] = np.logaddexp(ahead[b + 1], into)
            behind[n] = 0.0
            for k in reversed(range(len(places))):
                a, b = places[k]
                behind[a] = np.logaddexp(behind[a], np.logaddexp.reduce(moves + (scores[k] + behind[b + 1])[None, :], 1))
            total = np.logaddexp.reduce(ahead[n])
            for k, (a, b) in enumerate(places):
                share = np.exp(ahead[a][:, None] + moves + (scores[k] + behind[b + 1])[None, :] - total)
                grad += np.outer(rows[k], share.sum(0))
                grad_moves += share
                if (a, b) in gold:
                    grad[:, gold[a, b]] -= rows[k]
            last = 0
            for a, b in sorted(gold):
                grad_moves[last, gold[a, b]] -= 1
                last = gold[a, b]
        for value, g, s in ((weights, grad, squares[0]), (moves, grad_moves, squares[1])):
            s += g**2
            value -= 1.0 * g / np.sqrt(s)
    return weights, moves


def _scores(rows: np.ndarray, places: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
    scores = rows @ weights
    scores[[a != b for a, b in places], 0] = -np.inf  # what is nothing stands alone
    return scores


def field_spans(text: str, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the most probable segmentation of each island of the text.

    Segments are scored block by block; of a word that stays which segment and label lead best to each of its labels.
    """
    found = []
    for words in islands(text):
        context = text[max(0, words[0][0] - 32) : words[0][0]].split()
        n, size = len(words), len(KINDS) + 1
        best = np.full((n + 1, size), -np.inf)
        best[0, 0] = 0.0
        begins, labels = np.zeros((n + 1, size), np.int32), np.zeros((n + 1, size), np.int8)
        for first in range(0, n, BLOCK):
            rows, places = _segments(text, words, context[-1] if context else "", first, min(n, first + BLOCK))
            scores = _scores(rows, places, weights)
            for k, (a, b) in enumerate(places):
                through = best[a][:, None] + moves
                value = through.max(0) + scores[k]
                better = value > best[b + 1]
                best[b + 1, better] = value[better]
                begins[b + 1, better], labels[b + 1, better] = a, through.argmax(0)[better]
        at, y = n, int(best[n].argmax())
        while at > 0:
            a, came = int(begins[at, y]), int(labels[at, y])
            if y:
                start, end = words[a][0], words[at - 1][1]
                body = text[start:end]
                found.append((y - 1, start + len(body) - len(body.lstrip(_TRIM)), end - len(body) + len(body.rstrip(_TRIM))))
            at, y = a, came
    return [s for s in found if s[1] < s[2]]


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): base and all spans of each row as array<struct<kind, start, end>>, by kind, then start, then end."""
    kind = df.schema[id_col].dataType.simpleString()
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    model = trained()
    signs = np.zeros(256, bool)
    signs[[ord(c) for c in "0123456789@"]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(spans: list[tuple[int, int, int]]) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]

        for part in slices(batches, "text"):
            column = part.column("text")
            data, at = text_bytes(column)
            total = np.concatenate([[0], np.cumsum(signs[data])])
            base, spans = [[] for _ in range(len(column))], [[] for _ in range(len(column))]
            for row in np.flatnonzero(total[at[1:]] > total[at[:-1]]).tolist():
                text = column[row].as_py()
                first = base_spans(text)
                base[row], spans[row] = listed(first), listed(list({*first, *field_spans(text, *model)}))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(base, struct), pa.array(spans, struct)], names=[id_col, "base", "spans"])

    spans = "array<struct<kind:string,start:int,end:int>>"
    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"{id_col} {kind}, base {spans}, spans {spans}")
