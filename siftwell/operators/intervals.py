"""Joins of line ranges within a file.

An equality join on the file alone compares every range of a file with every other, which a file with very many
findings makes a product.  Here ranges meet by buckets of lines instead.  There are two widths: a range of up to
four narrow buckets is dealt to those, a longer one to wide ones, and one of more than 64 of these (over half a
million lines) stands for the whole file.  Two ranges of different kinds meet in buckets of the coarser width, and
a pair counts only in the bucket that holds the larger of the two starts, so it comes up once.  What is examined is then in
proportion to the ranges and the pairs that meet.

Rows of the left side in files that the right side lacks go before they are dealt out, and the others are dealt out only
to the widths that the right side has in their file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Powers of two: lines of a narrow and of a wide bucket.
NARROW, WIDE = 7, 13
_SHORT, _LONG, _WHOLE = 0, 1, 2
_INNER = ("_lo", "_hi", "_lo_right", "_hi_right", "_kind", "_kind_right", "_kinds", "_bucket")


def _kind(low: Column, high: Column) -> Column:
    lines = high - low + 1
    return F.when(lines <= 4 << NARROW, _SHORT).when(lines <= 64 << WIDE, _LONG).otherwise(_WHOLE)


def _bucket(line: Column, kind: Column) -> Column:
    return F.when(kind == _SHORT, F.shiftright(line, NARROW)).when(kind == _LONG, F.shiftright(line, WIDE)).otherwise(F.lit(0).cast("bigint"))


def candidates(left: DataFrame, right: DataFrame, keys: list[str], left_range: tuple[str, str], right_range: tuple[str, str], reach: int = 0) -> DataFrame:
    """Rows of left beside rows of right of the same keys whose ranges share a bucket, each pair once: all that come within reach lines, and few more.

    A range that ends before it starts spans the lines between.  Ranges with a null meet nothing.  Columns of the two sides
    differ but for the keys, and none begins with an underscore.
    """

    def spanned(df: DataFrame, names: tuple[str, str], tail: str, by: int) -> DataFrame:
        a, b = (F.col(n).cast("bigint") for n in names)
        placed = df.where(a.isNotNull() & b.isNotNull()).withColumns({f"_lo{tail}": F.least(a, b) - by, f"_hi{tail}": F.greatest(a, b) + by})
        return placed.withColumn(f"_kind{tail}", _kind(F.col(f"_lo{tail}"), F.col(f"_hi{tail}")))

    def dealt(df: DataFrame, tail: str) -> DataFrame:
        kind = F.greatest("_kind", "_kind_right")
        return df.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col(f"_lo{tail}"), kind), _bucket(F.col(f"_hi{tail}"), kind))))

    there = spanned(right, right_range, "_right", reach)
    kinds = there.groupBy(*keys).agg(F.sort_array(F.collect_set("_kind_right")).alias("_kinds"))
    here = dealt(spanned(left, left_range, "", 0).join(kinds, keys).withColumn("_kind_right", F.explode("_kinds")), "")
    there = dealt(there.withColumn("_kind", F.explode(F.array(*map(F.lit, (_SHORT, _LONG, _WHOLE))))), "_right")
    met = here.join(there, [*keys, "_kind", "_kind_right", "_bucket"])
    return met.where(F.col("_bucket") == _bucket(F.greatest("_lo", "_lo_right"), F.greatest("_kind", "_kind_right"))).drop(*_INNER)
