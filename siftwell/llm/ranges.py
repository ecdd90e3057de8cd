"""Ranges of ids of about equal numbers of rows, for work in the order of the ids without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most ranges that are told apart: their borders are a literal of the plan.
MOST_RANGES = 1 << 16


def borders(df: DataFrame, id_col: str, ranges: int) -> list:
    """Sorted distinct ids that cut df's rows into about that many ranges; at most MOST_RANGES of them."""
    ranges = min(MOST_RANGES, ranges)
    if ranges < 2:
        return []
    found = df.select(F.percentile_approx(id_col, [k / ranges for k in range(1, ranges)], max(10_000, 20 * ranges)).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_of(value: Column, found: list) -> Column:
    """How many of the sorted borders are at most value, by binary search; -1 for null."""
    if not found:
        return F.when(value.isNull(), -1).otherwise(0)
    table, n = F.array(*map(F.lit, found)), len(found)
    jumps = [1 << k for k in reversed(range(n.bit_length()))]

    def step(so_far: Column, jump: Column) -> Column:
        return so_far + F.when((so_far + jump <= n) & (F.get(table, so_far + jump - 1) <= value), jump).otherwise(0)

    return F.when(value.isNull(), -1).otherwise(F.aggregate(F.array(*map(F.lit, jumps)), F.lit(0), step))
