"""Which findings and ground-truth items an analysis looks at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.functions.paths import is_excluded, normalize_file_path


def is_security(tool: Column, issue_type: Column) -> Column:
    """Sonar's vulnerabilities and hotspots, Semgrep's security or untyped findings, and all of other tools."""
    name, kind = F.lower(F.coalesce(tool, F.lit(""))), F.upper(F.trim(F.coalesce(issue_type, F.lit(""))))
    return F.when(name == "sonar", kind.isin("VULNERABILITY", "SECURITY_HOTSPOT")).when(name == "semgrep", kind.isin("", "SECURITY")).otherwise(F.lit(True))


def by_mode(findings: DataFrame, mode: str) -> DataFrame:
    return findings if mode.strip().lower() == "all" else findings.where(is_security(F.col("tool"), F.col("issue_type")))


def with_path(findings: DataFrame, repo_name: str) -> DataFrame:
    return findings.withColumn("file_path", normalize_file_path(F.col("file_path"), repo_name))


def by_scope(findings: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Findings outside the excluded directories; file_path is normalised already."""
    return findings.where(~is_excluded(F.col("file_path"), prefixes)) if prefixes else findings


def flagged(findings: DataFrame, config: AnalysisConfig) -> DataFrame:
    """findings with normalised paths, and is_in_mode and is_in_scope."""
    mode = F.lit(True) if config.mode.strip().lower() == "all" else is_security(F.col("tool"), F.col("issue_type"))
    return with_path(findings, config.repo_name).withColumns({"is_in_mode": mode, "is_in_scope": ~is_excluded(F.col("file_path"), config.exclude_prefixes)})


def selected(findings: DataFrame, config: AnalysisConfig) -> DataFrame:
    """Mode filter, normalised paths, scope filter."""
    return by_scope(with_path(by_mode(findings, config.mode), config.repo_name), config.exclude_prefixes)


def filter_counts(findings: DataFrame, config: AnalysisConfig) -> DataFrame:
    """For each case and tool: findings loaded, removed by mode, removed by scope, and kept."""
    secure = F.lit(True) if config.mode == "all" else is_security(F.col("tool"), F.col("issue_type"))
    outside = is_excluded(normalize_file_path(F.col("file_path"), config.repo_name), config.exclude_prefixes)
    return findings.groupBy("suite_id", "case_id", "tool").agg(
        F.count("*").alias("loaded"),
        F.count_if(~secure).alias("removed_mode"),
        F.count_if(secure & outside).alias("removed_scope"),
        F.count_if(secure & ~outside).alias("kept"),
    )


def by_track(items: DataFrame, track: str | None) -> DataFrame:
    """Ground-truth items of one track (any case); all of them without one."""
    return items.where(F.lower(F.col("track")) == track.strip().lower()) if track and track.strip() else items


def suspicious_cases(features: DataFrame, gt_cases: DataFrame) -> DataFrame:
    """Cases with ground truth and clusters, none of which overlaps it."""
    with_gt = features.join(gt_cases.select("suite_id", "case_id").distinct(), ["suite_id", "case_id"], "left_semi")
    counted = with_gt.groupBy("suite_id", "case_id").agg(F.count("*").alias("cluster_count"), F.sum("gt_overlap").alias("gt_overlap_sum"))
    return counted.where("gt_overlap_sum = 0")
