"""Benchmark decontamination by canonical templates.

Texts become templates: numbers, names and units are replaced by placeholders of
their type, other words are lower-cased and stripped of punctuation.  Windows of
SEED template words, of which at least LITERALS are literal, are hashed and joined
with those of the benchmark, so a question with other numbers or names still
matches.  Windows whose offsets (place in the document less place in the item)
differ by at most DRIFT are one occurrence of the item, so inserted, deleted and
changed words only cost the windows that hold them.

The replaced values are the slots of a window; within one occurrence every value
of the item stands for the value of the document that it meets most often (if
several do as often: for itself, or for none), and every name of the document for
one name of the item in the same way; different numbers or units may become equal.
Words agree if they are among WINDOW successive words of the item (or in a shorter
item) whose matched slots all have these values.

An item's word counts if it is in a matched window whose words agree.  A document
leaks an item if SHARE of the item's words count, and at least LEAST_WORDS of them
(all words of a shorter item).

Items that windows could miss even in a verbatim copy (with less than SEED words to
spare, as few words are literal) are also found by all their words, lower-cased and
without the marks around them; words of marks alone, such as +, are kept here.  This
holds for items of a single word too.  Equal rows of the benchmark are one; different
texts of one item are judged by themselves, and the best one stands for the item.

The benchmark's hashes are sent to all tasks only if there are at most
MOST_HASHES of them; else the windows of all documents are shuffled.  Null and
empty texts have no windows; rows with equal ids are one document.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.words import Words, bodies, hash_ranges, mix, rolling, slices

SEED, LITERALS, WINDOW, DRIFT, SHARE, LEAST_WORDS = 5, 3, 10, 10, 0.5, 8
#: Eight bytes each.
MOST_HASHES = 1 << 20
_NUMBER, _UNIT, _NAME = 1, 2, 3
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_PLACEHOLDERS = mix(np.arange(1, 4, dtype=np.uint64))

# Words that count as units after a number, and as names at any place.
UNITS = """
kg g mg lb lbs oz ton tons km m cm mm mile miles foot feet ft inch inches in yard yards
l ml litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours
day days week weeks month months year years percent dollar dollars cent cents euro euros pound pounds
degree degrees mph kmh watt watts volt volts joule joules newton newtons meter meters metre metres
""".split()
NAMES = """
alice bob carol dave eve frank grace john mary james robert michael william david linda susan sarah anna emma
peter paul maria jose tom tim sam ben max kate jane lucy laura julia marco pierre hans
""".split()


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return np.sort(hash_ranges(data, end - [len(w) for w in words], end))


_UNIT_HASHES, _NAME_HASHES = _hash_words(UNITS), _hash_words(NAMES)
_DIGIT, _UPPER, _LETTER, _STOP = (np.zeros(256, bool) for _ in range(4))
_DIGIT[48:58] = _UPPER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_STOP[[ord(c) for c in ".!?:;"]] = True


class Template:
    """The template words of a column: hash, type (0 for literal) and place of each; those of row i are first[i] to first[i + 1]."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        data = words.data
        start, end = bodies(words)
        kept = start < words.end
        lower = Words(pc.utf8_lower(column))  # the same words
        lower_start, lower_end = bodies(lower)
        marks = lower_start >= lower.end
        self.all_first = words.first
        self.all_hashes = hash_ranges(lower.data, np.where(marks, lower.start, lower_start), np.where(marks, lower.end, lower_end))
        opening = np.ones(len(words), bool)
        same = np.diff(words.rows, prepend=-1) == 0
        later = np.flatnonzero(same)
        breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
        opening[later] = _STOP[data[words.end[later - 1] - 1]] | (breaks[words.start[later]] > breaks[words.end[later - 1]])
        start, end, opening = start[kept], end[kept], opening[kept]
        self.lower = lower.data
        self.lower_start, self.lower_end = lower_start[kept], lower_end[kept]
        total = np.concatenate([[0], np.cumsum(kept)])
        self.first = total[words.first]
        self.hashes = hash_ranges(self.lower, self.lower_start, self.lower_end)
        lead = data[start]
        second = data[np.minimum(start + 1, end - 1)]
        self.kind = np.zeros(len(start), np.int8)
        self.kind[(_UPPER[lead] & _LETTER[second] & ~opening) | np.isin(self.hashes, _NAME_HASHES)] = _NAME
        number = _DIGIT[lead]
        unit = np.zeros(len(number), bool)
        unit[1:] = number[:-1] & np.isin(self.hashes[1:], _UNIT_HASHES)
        self.kind[unit], self.kind[number] = _UNIT, _NUMBER
        slot = self.kind > 0
        self.words = self.hashes.copy()
        self.words[slot] = _PLACEHOLDERS[self.kind[slot] - 1]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each window within one row that has enough literal words."""
        if len(self.words) < SEED:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        literal = np.concatenate([[0], np.cumsum(self.kind == 0)])
        rows = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero((rows[SEED - 1 :] == rows[: len(rows) - SEED + 1]) & (literal[SEED:] - literal[:-SEED] >= LITERALS))
        return rolling(self.words, SEED)[at], at

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each run of width words, marks included, within one row; any width takes the same time."""
        n = len(self.all_hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        powers, inverse = (np.multiply.accumulate(np.full(len(self.all_hashes), f, np.uint64)) for f in (_FACTOR, _INVERSE))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.all_hashes * powers)])
        at = np.flatnonzero(np.searchsorted(self.all_first, np.arange(n), "right") == np.searchsorted(self.all_first, np.arange(n) + width - 1, "right"))
        return mix((total[at + width] - total[at]) * inverse[at] + np.uint64(width)), at

    def slots(self, at: int) -> list[str]:
        """Type, place in the window (a digit each) and lower-cased value of each placeholder of a window."""
        return [f"{self.kind[k]}{k - at}{self.lower[self.lower_start[k] : self.lower_end[k]].tobytes().decode('utf-8', 'replace')}" for k in range(at, at + SEED) if self.kind[k]]


def _kept(hashes: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Which hashes are among the sorted ones of wanted; all if that is None."""
    if wanted is None or not len(wanted):
        return np.full(len(hashes), wanted is None)
    return wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes


def _least(n: int, share: float) -> float:
    """The words of an item of n words that a leak has at least."""
    return max(share * n, min(n, LEAST_WORDS))


def _short(template: Template, share: float) -> np.ndarray:
    """The rows, of one word at least, that windows could miss in a verbatim copy."""
    counts = np.diff(template.first)
    covered = np.zeros(len(template.words), bool)
    covered[(template.windows()[1][:, None] + np.arange(SEED)).ravel()] = True
    sums = np.diff(np.concatenate([[0], np.cumsum(covered)])[template.first])
    return np.array([k for k, (n, c) in enumerate(zip(counts.tolist(), sums.tolist(), strict=True)) if n and c - SEED < _least(n, share)], np.int64)


def template_windows(df: DataFrame, share: float, widths: list[int] | None, wanted: np.ndarray | None = None) -> DataFrame:
    """(id, n_words, hash, place, slots) of the windows of df's (id, text); n_words is the text's.

    Runs of all words have slots null: those of widths or, if that is None, one for each item that windows could
    miss.  wanted: sorted hashes that are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            template = Template(part.column("text"))
            ids, counts = part.column("id"), np.diff(template.first)

            def found(hashes: np.ndarray, at: np.ndarray, first: np.ndarray, whole: bool, only: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
                good = _kept(hashes, wanted)
                hashes, at = hashes[good], at[good]
                row = np.searchsorted(first, at, "right") - 1
                if only is not None:
                    hashes, at, row = (x[np.isin(row, only)] for x in (hashes, at, row))
                for a in range(0, len(at), 20_000):
                    b = slice(a, a + 20_000)
                    slots = pa.array([None if whole else template.slots(k) for k in at[b].tolist()], pa.list_(pa.string()))
                    columns = [ids.take(pa.array(row[b])), pa.array(counts[row[b]]), pa.array(hashes[b].view(np.int64)), pa.array(at[b] - first[row[b]]), slots]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "hash", "place", "slots"])

            yield from found(*template.windows(), template.first, False)
            sizes = np.diff(template.all_first)
            short = _short(template, share) if widths is None else None
            for width in np.unique(sizes[short]).tolist() if widths is None else widths:
                yield from found(*template.runs(width), template.all_first, True, None if short is None else short[sizes[short] == width])

    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, n_words long, hash long, place long, slots array<string>")


def _slots(place: np.ndarray, item_place: np.ndarray, pairs: list[tuple[list[str], list[str]]]) -> set[tuple[int, int, str, str, str]]:
    """(word of the item, word of the document, type, value in the item, value in the document) of matched windows."""
    return {(q + int(y[1]), p + int(y[1]), y[0], y[2:], x[2:]) for p, q, (xs, ys) in zip(place.tolist(), item_place.tolist(), pairs, strict=True) for x, y in zip(xs, ys, strict=True)}


def _majority(votes: set[tuple[int, int, str, str]]) -> dict[str, str]:
    """The second value that each first one meets most often in votes (places, first, second): itself among equals, or none."""
    counts = defaultdict(Counter)
    for *_, a, b in votes:
        counts[a][b] += 1
    chosen = {}
    for a, found in counts.items():
        top = [b for b, c in found.items() if c == max(found.values())]
        if len(top) == 1 or a in top:
            chosen[a] = a if a in top else top[0]
    return chosen


def _disagreeing(slots: set[tuple[int, int, str, str, str]]) -> set[int]:
    """The item's words whose slots have no value of the majority."""
    typed = {(q, p, kind + y, kind + x) for q, p, kind, y, x in slots}
    there = _majority(typed)
    names = _majority({(q, p, x, y) for q, p, y, x in typed if x[0] == str(_NAME)})
    good = {q for q, _, y, x in typed if there.get(y) == x and (x[0] != str(_NAME) or names.get(x) == y)}
    return {q for q, *_ in typed} - good


def _agreeing(n: int, bad: set[int]) -> np.ndarray:
    """Which of an item's n words are in WINDOW words (or the whole item) without any of bad."""
    width = min(n, WINDOW)
    before = np.concatenate([[0], np.cumsum(np.isin(np.arange(n), list(bad)))])
    clear = np.flatnonzero(before[width:] == before[: n + 1 - width])
    return np.isin(np.arange(n), (clear[:, None] + np.arange(width)).ravel())


def _words(places: np.ndarray) -> np.ndarray:
    return np.unique(places[:, None] + np.arange(SEED))


def _best(n: int, seeds: list[dict], share: float) -> tuple[int, bool] | None:
    """Matched words of the best occurrence among matched windows of an item of n words, and whether its slots' values changed."""
    place, item_place = (np.array([s[c] for s in seeds]) for c in ("place", "item_place"))
    order = np.argsort(place - item_place, kind="stable")
    place, item_place = place[order], item_place[order]
    pairs = [(seeds[k]["slots"], seeds[k]["item_slots"]) for k in order]
    offset = place - item_place
    best, past = None, 0
    for a in np.flatnonzero(np.diff(offset, prepend=offset[0] - 1)).tolist():
        b = int(np.searchsorted(offset, offset[a] + DRIFT, "right"))
        if b == past:
            continue  # within the occurrence before
        past = b
        matched = min(len(_words(item_place[a:b])), len(_words(place[a:b])))
        if matched < _least(n, share) or (best and matched < best[0]):
            continue
        slots = _slots(place[a:b], item_place[a:b], pairs[a:b])
        agrees = _agreeing(n, _disagreeing(slots))
        kept = agrees[item_place[a:b, None] + np.arange(SEED)].all(axis=1)
        matched = min(len(_words(item_place[a:b][kept])), len(_words(place[a:b][kept])))
        if matched < _least(n, share):
            continue
        verbatim = {q for q, *_ in slots} == {q for q, _, _, y, x in slots if y == x}
        best = max(best or (0, False), (matched, verbatim))
        if best == (n, True):
            break
    return best and (best[0], not best[1])


def leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = SHARE, most_hashes: int = MOST_HASHES) -> DataFrame:
    """(id, item, n_words, n_matched, share, changed): items that documents leak.

    changed tells whether the best occurrence has other numbers, names or units than the item.
    """
    texts = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    texts = texts.select(F.struct("item", F.xxhash64("text").alias("version")).alias("id"), "text")
    items = template_windows(texts, share, None)
    items = items.select("id.item", "id.version", "n_words", "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    found = items.select("hash").distinct().limit(most_hashes + 1).toPandas()["hash"].to_numpy()
    wanted = np.sort(found.view(np.uint64)) if len(found) <= most_hashes else None
    rows = template_windows(documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), share, _short_widths(texts, share), wanted).where("id IS NOT NULL").drop("n_words")
    both = rows.join(items, "hash").where(F.col("slots").isNull() == F.col("item_slots").isNull())
    seed = F.when(F.col("slots").isNotNull(), F.struct("place", "item_place", "slots", "item_slots"))
    pairs = both.groupBy("id", "item", "version", "n_words").agg(F.collect_list(seed).alias("seeds"), F.max(F.col("slots").isNull()).alias("whole"))
    words = F.array_distinct(F.flatten(F.transform("seeds", lambda s: F.sequence(s["item_place"], s["item_place"] + (SEED - 1)))))
    likely = pairs.where(F.col("whole") | (F.size(words) >= F.greatest(F.col("n_words") * share, F.least(F.col("n_words"), F.lit(LEAST_WORDS)))))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 100):
                part = batch.slice(a, 100)
                sizes = part.column("n_words").to_pylist()
                found = zip(sizes, part.column("seeds").to_pylist(), part.column("whole").to_pylist(), strict=True)
                got = [(n, False) if whole else _best(n, seeds, share) for n, seeds, whole in found]
                hits = [k for k, g in enumerate(got) if g]
                columns = [*(part.column(c).take(pa.array(hits, pa.int64())) for c in ("id", "item", "n_words")), pa.array([got[k][0] for k in hits], pa.int64()), pa.array([got[k][1] for k in hits], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "item", "n_words", "n_matched", "changed"])

    kinds = {c: likely.schema[c].dataType.simpleString() for c in ("id", "item")}
    judged = likely.mapInArrow(judge, f"id {kinds['id']}, item {kinds['item']}, n_words long, n_matched long, changed boolean")
    part = F.col("n_matched") / F.col("n_words")
    best = judged.groupBy("id", "item").agg(F.max(F.struct(part.alias("share"), (~F.col("changed")).alias("verbatim"), "n_matched", "n_words")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.n_words", "best.n_matched", "best.share", (~F.col("best.verbatim")).alias("changed"))


def _short_widths(items: DataFrame, share: float) -> list[int]:
    """The numbers of words, marks included, of the items that windows could miss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            template = Template(part.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.diff(template.all_first)[_short(template, share)]).astype(np.int64))], names=["width"])

    return sorted(r["width"] for r in items.mapInArrow(run, "width long").distinct().collect())
