"""The sweep over ground-truth tolerances: clusters stay, only their overlaps change.

What a tolerance reaches, every larger one does.  So a cluster keeps, for each item near it, the smallest tolerance that
reaches it, and counts at all tolerances are sums over differences: one pass over the clusters serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.functions.scoring import round6
from siftwell.operators import calibration, evaluation
from siftwell.operators.groundtruth import CASE, overlaps


def overlap_stats(pairs: DataFrame, clusters: DataFrame, tolerances: tuple[int, ...]) -> DataFrame:
    """For each suite and tolerance: clusters with and without items, items covered, and ambiguous overlaps of both kinds."""
    keys = ["suite_id", "gt_tolerance"]
    distinct = pairs.where("gt_id <> ''").select(*keys, "case_id", "cluster_id", "gt_id").distinct()
    per_cluster = distinct.groupBy(*keys, "case_id", "cluster_id").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.count("*").alias("gt_overlap_1"), F.count_if(F.col("n") > 1).alias("clusters_multi_gt"), F.max("n").alias("max_gt_ids_per_cluster")
    )
    per_item = distinct.groupBy(*keys, "gt_id").agg(F.count("*").alias("n")).groupBy(*keys).agg(
        F.count("*").alias("gt_ids_covered"), F.count_if(F.col("n") > 1).alias("gt_ids_multi_cluster"), F.max("n").alias("max_clusters_per_gt_id")
    )
    totals = clusters.groupBy("suite_id").agg(F.count("*").alias("clusters_total")).select("*", F.explode(F.array(*map(F.lit, tolerances))).alias("gt_tolerance"))
    out = totals.join(per_cluster, keys, "left").join(per_item, keys, "left").na.fill(0)
    return out.select(
        *keys, "clusters_total", "gt_overlap_1", (F.col("clusters_total") - F.col("gt_overlap_1")).alias("gt_overlap_0"), round6(F.col("gt_overlap_1") / F.col("clusters_total")).alias("gt_overlap_rate"),
        "gt_ids_covered", "clusters_multi_gt", "gt_ids_multi_cluster", "max_clusters_per_gt_id", "max_gt_ids_per_cluster",
    )


def sweep(clusters: DataFrame, gt: DataFrame, tolerances: tuple[int, ...]) -> DataFrame:
    """overlap_stats for all tolerances, from one join."""
    return overlap_stats(overlaps(clusters, gt, tolerances), clusters, tolerances)


def warnings(stats: DataFrame) -> DataFrame:
    """stats with a list of its ambiguities."""

    def told(condition, label: str, name: str):
        return F.when(condition, F.concat(F.lit(f"{label}="), F.col(name).cast("string")))

    found = F.array_compact(F.array(
        told(F.col("clusters_multi_gt") > 0, "many_to_one_clusters", "clusters_multi_gt"),
        told(F.col("gt_ids_multi_cluster") > 0, "one_to_many_gt_ids", "gt_ids_multi_cluster"),
        told(F.col("max_gt_ids_per_cluster") > 1, "max_gt_ids_per_cluster", "max_gt_ids_per_cluster"),
        told(F.col("max_clusters_per_gt_id") > 1, "max_clusters_per_gt_id", "max_clusters_per_gt_id"),
    ))
    return stats.withColumn("warnings", found)


def select_tolerance(stats: DataFrame, min_fraction: float = 0.95) -> DataFrame:
    """For each suite the smallest tolerance with at least that share of the most positive clusters.

    Rows whose analysis_rc is not 0 count only where a suite has no others.
    """
    share = min(1.0, max(0.0, min_fraction))
    rows = stats if "analysis_rc" in stats.columns else stats.withColumn("analysis_rc", F.lit(0))
    ok = F.coalesce("analysis_rc", F.lit(0)) == 0
    good = rows.groupBy("suite_id").agg(F.max(ok).alias("_some_ok"), F.max(~ok).alias("_some_bad"))
    used = rows.join(good, "suite_id").where(ok | ~F.col("_some_ok"))
    most = used.groupBy("suite_id").agg(F.max("gt_overlap_1").alias("max_gt_positive_clusters"), F.max(F.col("_some_bad") & F.col("_some_ok")).alias("analysis_rc_filter_applied"))
    needed = most.withColumn("required_min", F.ceil(F.col("max_gt_positive_clusters") * F.lit(share) - 1e-9).cast("bigint"))
    hits = used.join(needed, "suite_id").where("gt_overlap_1 >= required_min")
    return hits.groupBy("suite_id").agg(
        F.min("gt_tolerance").alias("selected_gt_tolerance"), F.first("max_gt_positive_clusters").alias("max_gt_positive_clusters"), F.first("required_min").alias("required_min"),
        F.first("analysis_rc_filter_applied").alias("analysis_rc_filter_applied"), F.min_by("clusters_multi_gt", "gt_tolerance").alias("clusters_multi_gt"), F.min_by("gt_ids_multi_cluster", "gt_tolerance").alias("gt_ids_multi_cluster"),
    )


def effective_tolerance(selected: int | None, suite: int | None, requested: int | None) -> tuple[int, str]:
    """The tolerance to use and where it comes from: the stored selection, then the suite, then the request."""
    for value, source in ((selected, "selection"), (suite, "suite"), (requested, "requested")):
        if value is not None and value >= 0:
            return value, source
    return 0, "default"


def sweep_cases(clusters: DataFrame, gt: DataFrame, tolerances: tuple[int, ...]) -> DataFrame:
    """Positive clusters of each case at each tolerance."""
    return overlaps(clusters, gt, tolerances).groupBy(*CASE, "gt_tolerance").agg(F.count_distinct("cluster_id").alias("gt_overlap_1"))


def labels(near: DataFrame, tolerances: tuple[int, ...]) -> DataFrame:
    """Clusters with hits: (gt_tolerance, gt_id) of each item near, with the smallest of the tolerances that reaches it.  hits are sorted.

    near: clusters with owasp_id, from groundtruth.with_near() of the largest tolerance or more.
    """

    def reached(gap: Column) -> Column:
        return F.array_min(F.filter(F.array(*map(F.lit, tolerances)), lambda t: t >= gap))

    inside = F.filter("near", lambda x: (x["gap"] <= max(tolerances)) & (x["gt_id"] != ""))
    each = F.array_sort(F.transform(inside, lambda x: F.struct(x["gt_id"].alias("gt_id"), reached(x["gap"]).alias("gt_tolerance"))))
    rows = near.withColumn("_each", each)
    # an item's smallest tolerance comes first
    first = F.filter("_each", lambda x, i: (i == 0) | (F.get("_each", i - 1)["gt_id"] != x["gt_id"]))
    hits = F.array_sort(F.transform(first, lambda x: F.struct(x["gt_tolerance"].alias("gt_tolerance"), x["gt_id"].alias("gt_id"))))
    return rows.select(
        *CASE, "cluster_id", "owasp_id", "file_path", F.coalesce("start_line", F.lit(0)).alias("start_line"), "tools", "tool_count", "finding_count", "max_severity", "max_severity_rank", hits.alias("hits")
    )


def stats_at(rows: DataFrame, tolerances: tuple[int, ...]) -> DataFrame:
    """overlap_stats from labels()."""
    every = F.filter(F.array(*map(F.lit, tolerances)), lambda t: t >= F.col("hit.gt_tolerance"))
    pairs = rows.select(*CASE, "cluster_id", F.explode("hits").alias("hit")).select(*CASE, "cluster_id", "hit.gt_id", F.explode(every).alias("gt_tolerance"))
    return overlap_stats(pairs, rows, tolerances)


def _tool_hits(rows: DataFrame, tolerances: tuple[int, ...], *keys: str) -> DataFrame:
    """(keys, gt_tolerance, tool, tp, fp): clusters are counted once, by the tolerance that first reaches an item."""
    first = F.get("hits", F.lit(0))["gt_tolerance"]
    counted = rows.select(*keys, first.alias("first"), F.explode("tools").alias("tool")).groupBy(*keys, "tool", "first").agg(F.count("*").alias("n"))
    at = counted.withColumn("gt_tolerance", F.explode(F.array(*map(F.lit, tolerances))))
    hit = F.coalesce(F.col("first") <= F.col("gt_tolerance"), F.lit(False))
    return at.groupBy(*keys, "gt_tolerance", "tool").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(hit, 0).otherwise(F.col("n"))).alias("fp"))


def _with_items(rows: DataFrame, gt: DataFrame) -> DataFrame:
    return rows.join(gt.select(*CASE).distinct(), CASE, "left_semi")


def tools_at(rows: DataFrame, gt: DataFrame, config: AnalysisConfig) -> DataFrame:
    """The weights of each tool at each candidate tolerance, from labels()."""
    return calibration.with_weights(_tool_hits(_with_items(rows, gt), config.gt_tolerance_candidates, "suite_id"), config.calibration)


def models_at(rows: DataFrame, gt: DataFrame, config: AnalysisConfig) -> DataFrame:
    """calibration.model() at each candidate tolerance; the support of a category is the same at all of them."""
    known = _with_items(rows, gt).where("owasp_id IS NOT NULL")
    enough = known.groupBy("suite_id", "owasp_id").agg(F.count("*").alias("n")).where(F.col("n") >= config.calibration.min_support)
    slices = calibration.with_weights(_tool_hits(known, config.gt_tolerance_candidates, "suite_id", "owasp_id"), config.calibration).join(enough, ["suite_id", "owasp_id"], "left_semi")
    return calibration.as_model(tools_at(rows, gt, config), slices, ("suite_id", "gt_tolerance"))


def macro_at(rows: DataFrame, gt: DataFrame, models: DataFrame, config: AnalysisConfig) -> DataFrame:
    """Macro precision and coverage of each strategy and k at each candidate tolerance, from labels()."""
    tolerances, by = config.gt_tolerance_candidates, ("gt_tolerance",)
    ranked = evaluation.rankings_at(rows, models, config, max(config.ks), tolerances)
    found = evaluation.cases(rows.withColumn("gt_overlap", F.size("hits")), gt).withColumn("gt_tolerance", F.explode(F.array(*map(F.lit, tolerances))))
    return evaluation.macro(evaluation.by_case(ranked, found, config, by=by), by)


# The strategies and cut-offs that have columns of their own in the sweep's report.
WIDE_STRATEGIES = ("baseline", "agreement", "calibrated")
WIDE_KS = (1, 3, 5, 10, 25)


def wide_macro(macro: DataFrame) -> DataFrame:
    """One row per suite and tolerance: macro metrics as columns, and how far calibrated is above baseline."""
    measures = ("precision", "gt_coverage")
    columns = [F.max(F.when((F.col("strategy") == s) & (F.col("k") == k), F.col(m))).alias(f"macro_{m}_{s}_k{k}") for s in WIDE_STRATEGIES for k in WIDE_KS for m in measures]
    wide = macro.groupBy("suite_id", "gt_tolerance").agg(*columns)
    return wide.withColumns({f"delta_macro_{m}_calibrated_vs_baseline_k{k}": round6(F.col(f"macro_{m}_calibrated_k{k}") - F.col(f"macro_{m}_baseline_k{k}")) for k in WIDE_KS for m in measures})


def sweep_report(stats: DataFrame, macro: DataFrame) -> DataFrame:
    """One row per suite and tolerance: overlaps, ambiguities by their plain names too, warnings, and the macro columns."""
    told = warnings(stats)
    quoted = F.concat(F.lit("["), F.array_join(F.transform("warnings", lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", "), F.lit("]"))
    named = told.withColumns({
        "many_to_one_clusters": F.col("clusters_multi_gt"), "one_to_many_gt_ids": F.col("gt_ids_multi_cluster"), "gt_ambiguity_warning": F.when(F.size("warnings") > 0, 1).otherwise(0),
        "gt_ambiguity_warning_count": F.size("warnings"), "gt_ambiguity_warnings_json": quoted,
    })
    return named.drop("warnings").join(wide_macro(macro), ["suite_id", "gt_tolerance"], "left")


def parse_candidates(raw: str | None, default: tuple[int, ...] = AnalysisConfig.gt_tolerance_candidates) -> tuple[int, ...]:
    """Tolerances of a text, set apart by commas, semicolons or space: whole numbers from 0 on, each once, in order of mention; the default if there are none."""
    numbers = [int(x) for x in (raw or "").replace(",", " ").replace(";", " ").split() if x.lstrip("+-").isdigit()]
    return tuple(dict.fromkeys(n for n in numbers if n >= 0)) or default
