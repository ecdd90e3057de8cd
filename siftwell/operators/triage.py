"""The review queue and the feature table behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.functions.classification import infer_owasp, owasp_title
from siftwell.functions.parsing import sorted_json
from siftwell.functions.scoring import ratio, round6
from siftwell.operators.calibration import with_score
from siftwell.operators.clustering import ranked, severity_order
from siftwell.operators.groundtruth import CASE, near_values, with_near

SCHEMA_VERSION = "triage_features_v1"
PROVENANCE = ["repo_url", "repo_git_commit", "repo_git_branch", "repo_expected_commit", "repo_expected_branch", "case_track", "case_tags_json"]


def with_owasp(rows: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """rows with the OWASP code of their case: as declared with its ground truth (suite_id, case_id, owasp_id), else as its id says."""
    if declared is None:
        return rows.withColumn("owasp_id", infer_owasp(F.col("case_id")))
    told = rows.join(declared.select(*CASE, F.col("owasp_id").alias("_declared")), CASE, "left")
    return told.withColumn("owasp_id", infer_owasp(F.col("case_id"), F.col("_declared"))).drop("_declared")


def triage_queue(clusters: DataFrame, config: AnalysisConfig, model: DataFrame | None = None, declared: DataFrame | None = None) -> DataFrame:
    """Clusters in the order of review.  With a trust model the score comes first; without one it is null."""
    rows = with_owasp(clusters, declared)
    rows = rows.withColumn("triage_score_v1", F.lit(None).cast("double")) if model is None else with_score(rows, model, config.calibration)
    order = ([] if model is None else [F.desc(F.coalesce("triage_score_v1", F.lit(0.0)))]) + severity_order()
    return ranked(rows, order).select(
        *CASE, "rank", "triage_score_v1", "file_path", "start_line", "end_line", "tool_count", F.array_join("tools", ",").alias("tools"),
        F.col("finding_count").alias("total_findings"), "max_severity", F.col("sample.rule_id").alias("sample_rule_id"), F.col("sample.title").alias("sample_title"), "cluster_id",
    )


def triage_features(clusters: DataFrame, gt: DataFrame, config: AnalysisConfig, provenance: DataFrame | None = None, generated_at: str = "", declared: DataFrame | None = None) -> DataFrame:
    """One row per cluster with place, agreement, severity, diversity, rank, sample and ground-truth labels.

    provenance: (suite_id, case_id, repo_url, ...) of the cases; what it lacks is empty.  declared: see with_owasp().
    """
    found = {n: near_values(c, config.gt_tolerance) for c, n in (("gt_id", "gt_ids"), ("set_name", "gt_sets"), ("track", "gt_tracks"))}
    near = with_near(clusters, gt, config.gt_tolerance).withColumns(found).drop("near")
    rows = with_owasp(ranked(near, severity_order(), name="triage_rank"), declared)
    known = [c for c in PROVENANCE if provenance is not None and c in provenance.columns]
    if known:
        rows = rows.join(provenance.select(*CASE, *known), CASE, "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in known else F.lit("{}" if c == "case_tags_json" else "") for c in PROVENANCE})
    start, end = F.coalesce("start_line", F.lit(0)), F.coalesce("end_line", F.lit(0))
    others = F.col("finding_count") - sum((F.col(f"{t}_count") for t in config.tools), F.lit(0))
    counts = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, sorted(config.tools))), F.array(*[F.col(f"{t}_count") for t in sorted(config.tools)])), lambda k, v: v > 0)
    owasp = F.col("owasp_id")
    ref = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("repo_git_commit", "repo_expected_commit", "repo_git_branch", "repo_expected_branch")], F.lit(""))
    return rows.select(
        *CASE, "cluster_id", F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.lit(config.repo_name).alias("repo_name"), "repo_url", ref.alias("repo_ref"),
        "repo_git_commit", "repo_git_branch", "repo_expected_commit", "repo_expected_branch", "case_track", "case_tags_json",
        F.coalesce(owasp, F.lit("")).alias("owasp_id"), F.coalesce(owasp_title(owasp), F.lit("")).alias("owasp_title"),
        "file_path", start.alias("start_line"), end.alias("end_line"), F.when((start > 0) & (end >= start), end - start + 1).otherwise(0).alias("line_span"),
        F.to_json("tools").alias("tools_json"), F.array_join("tools", ",").alias("tools"), "tool_count", F.lit(len(config.tools)).alias("suite_tool_count"),
        round6(F.coalesce(ratio(F.col("tool_count"), F.lit(len(config.tools))), F.lit(0.0))).alias("agreement_tool_ratio"), sorted_json(counts).alias("tool_counts_json"), "finding_count",
        *[f"{t}_count" for t in config.tools], others.alias("other_tool_count"), "max_severity", "max_severity_rank",
        "severity_high_count", "severity_medium_count", "severity_low_count", "severity_unknown_count", "unique_rule_count", "unique_title_count", "unique_finding_id_count",
        "triage_rank", *[F.col(f"sample.{c}").alias(f"sample_{c}") for c in ("tool", "rule_id", "title", "severity")],
        F.when(F.size("gt_ids") > 0, 1).otherwise(0).alias("gt_overlap"), F.size("gt_ids").alias("gt_overlap_count"),
        *[x for n, c in (("ids", "gt_ids"), ("sets", "gt_sets"), ("tracks", "gt_tracks")) for x in (F.to_json(c).alias(f"gt_overlap_{n}_json"), F.array_join(c, ";").alias(f"gt_overlap_{n}"))],
    )
