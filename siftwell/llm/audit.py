"""How filters interact: what each removes at each place of every order, and its Shapley value.

A document's failures are a mask, one bit a filter, so the whole table comes down to counts of masks by part: 2 ** 5
cells a part, whatever the number of documents.  The orders of the filters are visited by adjacent transpositions (the
plain changes of bell ringers): one swap of neighbours leads from each order to the next, and only the two steps that
trade places are computed anew from the cells.  A filter's Shapley sum grows along the walk: when one of its steps
changes, the old number is added as often as it was in force.

The duplicate filter fails rows whose text also stands under a smaller id.  Rows come down to counts by (text hash, mask,
part, labels, id), then lose the id, keeping the smallest and how many rows have it; last, the groups of one hash (as many as parts
times labels, whatever the number of copies) are compared.  So no copies meet in one task beyond what combines before the shuffle.

Null texts count as empty, and equal one another; a null part is the empty string; a row with a null id is never a
duplicate of a smaller id, nor does it make others one, nor has it labels.  Labels of a repeated id count if any of its rows says 1.  An empty
table gives no rows.  Columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
DUPLICATE = 16
#: Parts whose rows are made at once.
PARTS = 64
_SPACE = r"[\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """The bits of filters A to D: under 100 words, repetitive, shouting, symbols."""
    words = F.array_remove(F.split(text, _SPACE), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [count < 100, 100 * distinct < 80 * count, 100 * capitals > 10 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def masks(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and how many are labelled good and toxic."""
    text = F.coalesce(df[text_col], F.lit(""))
    rows = df.select(df[id_col].alias("id"), F.coalesce(df[part_col].cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"), text_mask(text).alias("mask"))
    known = labels.groupBy(labels[id_col].alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    kinds = ["key", "mask", "part", "good", "toxic"]
    marked = rows.join(known, "id", "left").na.fill(0, ["good", "toxic"]).groupBy("id", *kinds).agg(F.count("*").alias("n"))
    # min_by passes over null ids, so n_first is null where there is no other; such rows are never duplicates
    groups = marked.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    member = F.struct("part", "good", "toxic", "n", "first", "n_first", "n_null")
    texts = groups.groupBy("key", "mask").agg(F.min("first").alias("least"), F.collect_list(member).alias("members"))
    each = texts.select("mask", "least", F.inline("members"))
    unique = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    flags = [(unique, F.col("mask")), (F.col("n") - unique, F.col("mask") + DUPLICATE)]
    split = each.select("part", "good", "toxic", F.explode(F.array(*[F.struct(m.alias("mask"), n.alias("n")) for n, m in flags])).alias("cell"))
    cell = split.select("part", "cell.mask", "cell.n", "good", "toxic").where("n > 0")
    return cell.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def swaps(n: int) -> list[int]:
    """The left places of the neighbours to swap, one after another, to pass through all orders of n things once."""
    if n < 2:
        return []
    inner, found = swaps(n - 1), []
    for k in range(len(inner) + 1):  # the last thing runs through the others, now down, now up
        run = range(n - 2, -1, -1) if k % 2 == 0 else range(n - 1)
        found += run
        if k < len(inner):
            found.append(inner[k] + (k % 2 == 0))
    return found


MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


class Walk:
    """Steps of every order, for the cells of some parts: arrays of (parts, masks)."""

    def __init__(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray):
        self.cells = (n, good, toxic)
        self.mask = np.arange(n.shape[1])
        self.filters = n.shape[1].bit_length() - 1

    def step(self, before: int, which: int) -> np.ndarray:
        """(measures, parts) of one filter behind those whose bits are in before."""
        n, good, toxic = self.cells
        bit = 1 << which
        fails, alive = self.mask & bit != 0, self.mask & before == 0
        here = fails & alive
        return np.stack([n[:, alive & ~fails].sum(1), n[:, here].sum(1), n[:, fails & ~alive].sum(1), n[:, bit], good[:, here].sum(1), toxic[:, here].sum(1)])

    def orders(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The orders, their steps (orders, steps, measures, parts), and the Shapley sums (filters, parts)."""
        order = list(range(self.filters))
        prefix = np.concatenate([[0], np.cumsum([1 << f for f in order])])  # bits of the filters before each step
        now = np.stack([self.step(int(prefix[k]), f) for k, f in enumerate(order)])
        shapley = np.zeros((self.filters, len(self.cells[0])), np.int64)
        since = [0] * self.filters
        names, steps = ["".join(FILTERS[f] for f in order)], [now.copy()]

        def settle(which: int, place: int) -> None:
            shapley[which] += now[place, 1] * (len(names) - since[which])
            since[which] = len(names)

        for left in swaps(self.filters):
            a, b = order[left], order[left + 1]
            settle(a, left)
            settle(b, left + 1)
            order[left], order[left + 1] = b, a
            prefix[left + 1] = prefix[left] | 1 << b
            now[left], now[left + 1] = self.step(int(prefix[left]), b), self.step(int(prefix[left + 1]), a)
            names.append("".join(FILTERS[f] for f in order))
            steps.append(now.copy())
        for place, which in enumerate(order):
            settle(which, place)
        return names, np.stack(steps), shapley


def _rows(parts: list[str], n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> pa.RecordBatch:
    """One row per part, order and step."""
    names, steps, shapley = Walk(n, good, toxic).orders()
    steps = np.moveaxis(steps, 3, 0)  # parts first
    filters = steps.shape[2]
    which = np.array([[FILTERS.index(c) for c in name] for name in names])
    columns = [
        pa.array(np.repeat(np.array(parts, object), len(names) * filters), pa.string()),
        pa.array(names).take(pa.array(np.tile(np.repeat(np.arange(len(names)), filters), len(parts)))),
        pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), len(parts) * len(names))),
        *[pa.array(steps[:, :, :, k].ravel()) for k in range(len(MEASURES))],
        pa.array(shapley.T[:, which].ravel()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES, "shapley"])


def interactions(cells: DataFrame) -> DataFrame:
    """(part, filter_order, step, measures, shapley) from masks(): a row for each part, order of the filters and step in it."""
    cell = F.struct("mask", "n", "good", "toxic")
    parts = cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))  # 2 ** 5 cells at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS):
                few = batch.slice(at, PARTS).to_pylist()
                n, good, toxic = np.zeros((3, len(few), 1 << len(FILTERS)), np.int64)
                for k, row in enumerate(few):
                    for c in row["cells"]:
                        n[k, c["mask"]], good[k, c["mask"]], toxic[k, c["mask"]] = c["n"], c["good"], c["toxic"]
                yield _rows([row["part"] for row in few], n, good, toxic)

    longs = ", ".join(f"{m} long" for m in [*MEASURES, "shapley"])
    return parts.mapInArrow(run, f"part string, filter_order string, step int, {longs}")
