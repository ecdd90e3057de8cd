"""The star schema for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.classification import infer_owasp, owasp_title

MARGINAL_METRICS = [
    "precision_full", "precision_drop", "delta_precision", "gt_coverage_full", "gt_coverage_drop", "delta_gt_coverage", "neg_in_topk_full", "neg_in_topk_drop", "delta_neg_in_topk",
    "gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters", "clusters_with_tool", "clusters_exclusive_total", "clusters_exclusive_pos", "clusters_exclusive_neg",
]
UTILITY_METRICS = ["gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters"]


def fact_eval_case_k(by_case: DataFrame, benchmark_id: str) -> DataFrame:
    """by_case() rows under the mart's names; a missing ratio is 0."""
    return by_case.select(
        F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), "case_id", "strategy", "k", "n_clusters", "has_gt", "gt_total",
        F.coalesce("precision", F.lit(0.0)).alias("precision_at_k"), "tp_at_k", "denom_at_k", F.coalesce("gt_coverage", F.lit(0.0)).alias("coverage_at_k"), "gt_covered_at_k",
    )


def fact_eval_suite_k(macro: DataFrame, micro: DataFrame, benchmark_id: str) -> DataFrame:
    """Both aggregates in one table; counts that one of them lacks are 0."""
    counts = ["precision_cases", "gt_coverage_cases", "tp_at_k", "denom_at_k", "gt_covered_at_k", "gt_total"]

    def shaped(df: DataFrame, kind: str) -> DataFrame:
        found = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in df.columns else F.lit(0).cast("bigint").alias(c) for c in counts]
        return df.select(F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), F.lit(kind).alias("agg_type"), "strategy", "k", F.coalesce("precision", F.lit(0.0)).alias("precision_at_k"), F.coalesce("gt_coverage", F.lit(0.0)).alias("coverage_at_k"), *found)

    return shaped(macro, "macro").unionByName(shaped(micro, "micro")).withColumnRenamed("gt_coverage_cases", "coverage_cases")


def fact_tool_value(utility: DataFrame, marginal: DataFrame, benchmark_id: str) -> DataFrame:
    """Every tool metric as a row; missing values are left out."""
    one = utility.select("suite_id", "tool", *[F.col(c).cast("double").alias(c) for c in UTILITY_METRICS]).unpivot(["suite_id", "tool"], UTILITY_METRICS, "m", "metric_value")
    one = one.select("suite_id", "tool", F.lit("utility").alias("metric_group"), F.lit("").alias("strategy"), F.lit(None).cast("int").alias("k"), F.concat(F.lit("utility."), "m").alias("metric_name"), "metric_value")
    two = marginal.select("suite_id", "tool", "strategy", "k", *[F.col(c).cast("double").alias(c) for c in MARGINAL_METRICS]).unpivot(["suite_id", "tool", "strategy", "k"], MARGINAL_METRICS, "m", "metric_value")
    two = two.select("suite_id", "tool", F.lit("marginal").alias("metric_group"), "strategy", "k", F.concat(F.lit("marginal."), "strategy", F.lit(".k"), F.col("k").cast("string"), F.lit("."), "m").alias("metric_name"), "metric_value")
    both = one.unionByName(two).where("metric_value IS NOT NULL")
    return both.select(F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), "tool", "metric_group", "strategy", "k", "metric_name", "metric_value")


def dim_case(cases: DataFrame, benchmark_id: str, manifests: DataFrame | None = None) -> DataFrame:
    """Cases of each suite with their OWASP category and ground truth; manifests add track, repository and tags."""
    more = ["track", "repo_label", "runs_repo_name", "expected_branch", "expected_commit", "tags_json"]
    rows = cases
    if manifests is not None:
        rows = rows.join(manifests.select("case_id", *[c for c in more if c in manifests.columns]), "case_id", "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("") for c in more})
    owasp = infer_owasp(F.concat_ws(" ", "case_id", "expected_branch", "repo_label", "tags_json"))
    return rows.select(
        F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), "case_id", F.concat(F.lit("cases/"), "case_id").alias("case_dir"), F.coalesce(owasp, F.lit("")).alias("owasp_id"), F.coalesce(owasp_title(owasp), F.lit("")).alias("owasp_title"),
        "has_gt", "gt_total", *more,
    )


def dim_tool_run(runs: DataFrame, benchmark_id: str) -> DataFrame:
    """Tool runs (see provenance.tool_runs) under the mart's names."""
    return runs.select(F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), *[c for c in runs.columns if c != "suite_id"])


def dim_suite_run(findings: DataFrame, benchmark_id: str, tolerance: int, gt_tolerance: int, mode: str) -> DataFrame:
    """One row per suite: its settings, scanners and their signature."""
    tools = F.array_sort(F.collect_set("tool"))
    rows = findings.groupBy("suite_id").agg(F.to_json(tools).alias("scanners_json"))
    return rows.select(
        F.col("suite_id").alias("suite_run_id"), F.lit(benchmark_id).alias("benchmark_id"), F.lit(tolerance).alias("analysis_tolerance"), F.lit(mode).alias("analysis_filter"),
        F.lit(gt_tolerance).alias("gt_tolerance_effective"), "scanners_json", F.sha2("scanners_json", 256).alias("toolset_signature"),
    )
