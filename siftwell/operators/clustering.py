"""Clusters of findings by file and line range."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.severity import bucket, severity_rank
from siftwell.sinks.shared import stored

FILE = ["suite_id", "case_id", "file_path"]
CLUSTER = [*FILE, "cluster_id", "start_line", "end_line"]


def assign_clusters(items: DataFrame, tolerance: int) -> DataFrame:
    """items with cluster_id, start_line and end_line.

    Within a file, lines that begin at most tolerance after the largest end so far join the cluster; missing or
    non-positive lines make up the cluster file:unknown.  The sweep runs over the distinct lines of a file, so a
    file with very many findings makes no large window; only findings that end more than tolerance before they
    start stay apart there, as later ones of the same line may open another cluster.
    """
    tolerance = max(0, tolerance)
    line = F.when(F.col("line_number") > 0, F.col("line_number"))
    end = F.coalesce("end_line_number", line)
    placed = items.withColumns({"_line": line, "_apart": F.when(end < line - tolerance, F.col("item_seq")).otherwise(-1)})
    lines = placed.where("_line IS NOT NULL").groupBy(*FILE, "_line", "_apart").agg(F.max(F.coalesce("end_line_number", "_line")).alias("_end"), F.min("item_seq").alias("_seq"))
    sweep = Window.partitionBy(*FILE).orderBy("_line", "_seq", "_apart").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("_end").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("_line") > reach + tolerance), 1).otherwise(0)
    islands = lines.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(sweep))
    whole = Window.partitionBy(*FILE, "_island")
    ranges = islands.select(*FILE, "_line", "_apart", F.min("_line").over(whole).alias("start_line"), F.max("_end").over(whole).alias("end_line"))
    spot = F.concat(F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string"))
    return placed.join(ranges, [*FILE, "_line", "_apart"], "left").withColumn("cluster_id", F.concat("file_path", F.lit(":"), F.coalesce(spot, F.lit("unknown")))).drop("_line", "_apart")


def first_filled(name: str, order: Column) -> Column:
    """The first nonempty value of a text column in the given order; empty without one."""
    return F.coalesce(F.min_by(name, F.when(F.col(name) != "", order)), F.lit(""))


def _facts(tools: tuple[str, ...], distinct: Callable[[Column], Column]) -> list[Column]:
    """What reports need of a cluster's findings but for its tools: counts, severities, sample finding.  distinct counts a column's different values."""
    rank = severity_rank(F.col("severity"))
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("tool", "rule_id", "title", "finding_id")}
    order = F.struct("item_seq", *[blank[c].alias(c) for c in ("tool", "rule_id", "title", "finding_id")], F.coalesce("severity", F.lit("")).alias("severity"))
    known = F.when(rank > 0, F.struct(rank.alias("rank"), (-F.col("item_seq")).alias("seq"), blank["tool"].alias("tool"), F.col("severity")))
    sample = F.struct(blank["tool"].alias("tool"), blank["rule_id"].alias("rule_id"), blank["title"].alias("title"), F.coalesce("severity", F.lit("")).alias("severity"))
    choice = F.struct((-rank).alias("r"), *[blank[c].alias(c) for c in ("tool", "rule_id", "title", "finding_id")], F.col("item_seq").alias("s"), F.coalesce("severity", F.lit("")).alias("severity"))
    unique = {f"unique_{n}_count": distinct(F.when(F.col(c) != "", F.col(c))) for n, c in (("rule", "rule_id"), ("title", "title"), ("finding_id", "finding_id"))}
    counts = [F.count_if(F.col("tool") == t).alias(f"{t}_count") for t in tools]
    labels = [F.count_if(bucket(F.col("severity")) == x).alias(f"severity_{x.lower()}_count") for x in ("HIGH", "MEDIUM", "LOW", "UNKNOWN")]
    return [
        F.count("*").alias("finding_count"),
        F.max(rank).alias("max_severity_rank"),
        F.coalesce(F.max(known)["severity"], F.lit("")).alias("max_severity"),
        F.min_by(sample, choice).alias("sample"),
        first_filled("rule_id", order).alias("first_rule_id"),
        first_filled("title", order).alias("first_title"),
        *[x.alias(n) for n, x in unique.items()],
        *counts,
        *labels,
    ]


def summarize_clusters(assigned: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """One row per cluster: its tools, counts, severities, sample finding and what else the reports need."""
    grouped = assigned.groupBy(*CLUSTER).agg(F.array_sort(F.collect_set("tool")).alias("tools"), *_facts(tools, F.count_distinct))
    return grouped.withColumn("tool_count", F.size("tools"))


def with_names(rows: DataFrame) -> DataFrame:
    """rows of clusters with what their other columns tell: cluster_id and tool_count."""
    spot = F.concat(F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string"))
    return rows.withColumns({"cluster_id": F.concat("file_path", F.lit(":"), F.coalesce(spot, F.lit("unknown"))), "tool_count": F.size("tools")})


#: Findings that a file may have for its rows to be dealt to one task as they are; bins of files in which they are counted; tools that have a column of their own.
CROWD, BINS, NAMES = 1 << 20, 1 << 13, 64


def clusters_of(items: DataFrame, tolerance: int, tools: tuple[str, ...]) -> DataFrame:
    """The rows of summarize_clusters(assign_clusters(items)), from a single exchange of the findings where no file has very many.

    A first look counts findings by bins of files.  If no bin holds more than CROWD, no file does, and all findings of a file
    may meet in one task, where one sort serves the sweep and the sums.  Otherwise, or if findings end more than tolerance before
    they start (whose clusters may share a range), clusters come from the distinct lines.  Plans carry the columns that are asked for.
    """
    tolerance, keys = max(0, tolerance), FILE[::-1]  # the file comes first: sorts tell most rows apart by its first bytes
    line = F.when(F.col("line_number") > 0, F.col("line_number"))
    reversed_ = F.coalesce(F.col("end_line_number") < line - tolerance, F.lit(False))
    bins = items.groupBy(F.pmod(F.xxhash64(*keys), F.lit(BINS)).alias("_bin"), "tool").agg(F.count("*").alias("n"), F.max(reversed_).alias("_reversed"))
    whole = bins.groupBy("_bin").agg(F.sum("n").alias("n"), F.max("_reversed").alias("_reversed"), F.collect_set("tool").alias("tools"))
    seen = whole.agg(F.max("n").alias("n"), F.max("_reversed").alias("_reversed"), F.array_distinct(F.flatten(F.collect_set("tools"))).alias("tools")).first()
    names = sorted(seen["tools"])
    if (seen["n"] or 0) > CROWD or seen["_reversed"] or len(names) > NAMES:
        return summarize_clusters(assign_clusters(items, tolerance), tools)
    placed = items.withColumns({"_line": line, "_end": F.when(line.isNotNull(), F.coalesce("end_line_number", line))})
    sweep = Window.partitionBy(*keys).orderBy("_line", "item_seq").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("_end").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    # rows without a line come first, as island 0
    opens = F.when(F.col("_line").isNull(), 0).when(reach.isNull() | (F.col("_line") > reach + tolerance), 1).otherwise(0)
    islands = placed.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(sweep))
    has = {f"_has_{k}": name for k, name in enumerate(names)}
    grouped = islands.groupBy(*keys, "_island").agg(
        F.min("_line").alias("start_line"), F.max("_end").alias("end_line"), *[F.count_if(F.col("tool") == name).alias(c) for c, name in has.items()], *_facts(tools, lambda x: F.size(F.collect_set(x)).cast("bigint"))
    )
    named = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(name)) for c, name in has.items()])) if has else F.array().cast("array<string>")
    return with_names(grouped.withColumn("tools", named)).drop("_island", *has)


def severity_order() -> list[Column]:
    """The order of the review queue: severity, agreement, size, place."""
    return [F.desc("max_severity_rank"), F.desc("tool_count"), F.desc("finding_count"), F.asc("file_path"), F.asc(F.coalesce("start_line", F.lit(0))), F.asc("cluster_id")]


def agreement_order() -> list[Column]:
    """Agreement before severity."""
    severity, tools, *rest = severity_order()
    return [tools, severity, *rest]


def ranked(rows: DataFrame, order: list[Column], keys: tuple[str, ...] = ("suite_id", "case_id"), name: str = "rank") -> DataFrame:
    """rows with their place within a case, however many of the rows one case holds.

    The rows are dealt out by ranges of case and order and written, numbered within each range.  A case's ranges are few, so
    the numbers that its earlier ranges hold come from a small table of counts.
    """
    sides = [F.asc(k) for k in keys]
    sorted_ranges = rows.repartitionByRange(*sides, *order).sortWithinPartitions(*sides, *order)
    placed = stored(sorted_ranges.withColumn("_place", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_place", 33)))
    counts = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_from")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[f"_{k}" for k in keys]).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    numbered = placed.join(starts, reduce(Column.__and__, same, F.col("_range") == F.col("_from")))
    return numbered.select(*rows.columns, (F.col("_place") - F.col("_start")).cast("int").alias(name))
