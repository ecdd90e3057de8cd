"""Differences between two runs of a suite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["section", "name", "tool", "strategy", "k"]


def unpivoted(df: DataFrame, section: str, metrics: list[str], tool: str | None = None, strategy: str | None = None, k: str | None = None, prefix: str | None = None) -> DataFrame:
    """(section, name, tool, strategy, k, value) of the metrics of df; prefix: a column whose value goes before the name."""
    keys = [F.col(c).cast("string") if c else F.lit("") for c in (tool, strategy)]
    rows = df.select(*[x.alias(n) for x, n in zip(keys, ("tool", "strategy"), strict=True)], (F.col(k).cast("int") if k else F.lit(None).cast("int")).alias("k"), (F.col(prefix) if prefix else F.lit(None).cast("string")).alias("_of"), *[F.col(m).cast("double").alias(m) for m in metrics])
    long = rows.unpivot(["tool", "strategy", "k", "_of"], metrics, "name", "value")
    return long.select(F.lit(section).alias("section"), F.concat_ws(":", "name", "_of").alias("name"), "tool", "strategy", "k", "value")


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two runs' long tables; the delta is b - a, null if either is missing."""
    one, two = (df.select(*[F.col(c).alias(f"{c}_{x}") for c in KEYS], F.col("value").alias(x)) for x, df in (("a", a), ("b", b)))
    key = [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in KEYS]
    both = one.join(two, reduce(lambda x, y: x & y, key), "full_outer")
    return both.select(*[F.coalesce(f"{c}_a", f"{c}_b").alias(c) for c in KEYS], "a", "b", (F.col("b") - F.col("a")).alias("delta"))


# The order of a drift report's sections; others come before the last.
SECTIONS = ("policy", "scanner_config", "dataset", "eval_micro", "eval_macro", "calibration_weight_global", "calibration_weight_by_owasp", "tool_utility", "tool_marginal")
LAST = "alerts"


def ordered(rows: DataFrame) -> DataFrame:
    """Rows of compared() in the order of a report: by section, then by name, tool, strategy and k."""
    place = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    rank = F.when(F.col("section") == LAST, len(SECTIONS) + 2).when(place > 0, place).otherwise(len(SECTIONS) + 1)
    return rows.orderBy(rank, "section", F.concat_ws(":", "name", "tool", "strategy"), F.concat("tool", "strategy"), F.coalesce("k", F.lit(0)))


def long_table(counts: DataFrame, macro: DataFrame, micro: DataFrame, weights: DataFrame, by_owasp: DataFrame, utility: DataFrame, marginal: DataFrame | None = None) -> DataFrame:
    """Everything a drift report compares about one run."""
    parts = [
        unpivoted(counts, "dataset", ["clusters_total", "clusters_gt_pos", "clusters_gt_neg", "cases_seen"]),
        unpivoted(micro, "eval_micro", ["precision", "gt_coverage"], strategy="strategy", k="k"),
        unpivoted(macro, "eval_macro", ["precision", "gt_coverage"], strategy="strategy", k="k"),
        unpivoted(weights, "calibration_weight_global", ["weight"], tool="tool"),
        unpivoted(by_owasp, "calibration_weight_by_owasp", ["weight"], tool="tool", prefix="owasp_id"),
        unpivoted(utility, "tool_utility", ["gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters"], tool="tool"),
    ]
    if marginal is not None:
        parts.append(unpivoted(marginal, "tool_marginal", ["delta_precision", "delta_gt_coverage", "delta_neg_in_topk"], tool="tool", strategy="strategy", k="k"))
    return reduce(DataFrame.unionByName, parts)


def dataset_counts(features: DataFrame) -> DataFrame:
    """Clusters, positive and negative ones, and cases of each suite."""
    positive = F.col("gt_overlap") == 1
    return features.groupBy("suite_id").agg(F.count("*").alias("clusters_total"), F.count_if(positive).alias("clusters_gt_pos"), F.count_if(~positive).alias("clusters_gt_neg"), F.count_distinct(F.when(F.col("case_id") != "", F.col("case_id"))).alias("cases_seen"))


def clusters_by_tool(rows: DataFrame) -> DataFrame:
    """Clusters that each tool has a part in."""
    return rows.select("suite_id", F.explode("tools").alias("tool")).groupBy("suite_id", "tool").agg(F.count("*").alias("clusters"))


def alerts(a: dict, b: dict) -> list[str]:
    """What changed between two runs' settings: tolerance, scanner profile, tools with another configuration, warnings."""
    found = []
    if a.get("effective_gt_tolerance") != b.get("effective_gt_tolerance"):
        found.append(f"GT tolerance changed: {a.get('effective_gt_tolerance')} -> {b.get('effective_gt_tolerance')}")
    if a.get("profile") and b.get("profile") and a["profile"] != b["profile"]:
        found.append(f"Scanner profile changed: {a['profile']} -> {b['profile']}")
    one, two = a.get("config_hashes") or {}, b.get("config_hashes") or {}
    changed = sorted(t for t in {*one, *two} if sorted(one.get(t) or []) != sorted(two.get(t) or []))
    if changed:
        found.append(f"Scanner config signature changed for tools: {changed}")
    for name, run in (("A", a), ("B", b)):
        if run.get("warnings"):
            found.append(f"Suite {name} warnings: {', '.join(sorted(set(run['warnings'])))}")
    return found
