"""Trust weights of the tools, learned from clusters with ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import CalibrationParams
from siftwell.functions.classification import owasp_id
from siftwell.functions.parsing import parse_tools
from siftwell.functions.scoring import log_odds, round6, smoothed_precision, triage_score


def labelled(features: DataFrame, gt_cases: DataFrame) -> DataFrame:
    """(suite_id, case_id, tools, gt_overlap, owasp_id) of the clusters in cases with ground truth, from features or evaluation's rows."""
    rows = features.join(gt_cases.select("suite_id", "case_id").distinct(), ["suite_id", "case_id"], "left_semi")
    tools = parse_tools(F.col("tools_json"), F.col("tools")) if "tools_json" in features.columns else F.col("tools")
    return rows.select("suite_id", "case_id", tools.alias("tools"), "gt_overlap", owasp_id(F.col("owasp_id")).alias("owasp_id"))


def with_weights(counts: DataFrame, params: CalibrationParams) -> DataFrame:
    """Counts (tp, fp) of each tool with its smoothed precision and weight."""
    p = smoothed_precision(F.col("tp"), F.col("fp"), params)
    return counts.withColumns({"p_smoothed": round6(p), "weight": round6(log_odds(p, params))})


def _hits(df: DataFrame, *keys: str) -> DataFrame:
    rows = df.select(*keys, "gt_overlap", F.explode("tools").alias("tool"))
    return rows.groupBy(*keys, "tool").agg(F.count_if(F.col("gt_overlap") == 1).alias("tp"), F.count_if(F.col("gt_overlap") != 1).alias("fp"))


def global_weights(rows: DataFrame, params: CalibrationParams) -> DataFrame:
    """(suite_id, tool, tp, fp, p_smoothed, weight) from labelled() rows."""
    return with_weights(_hits(rows, "suite_id"), params)


def weights_by_owasp(rows: DataFrame, params: CalibrationParams) -> DataFrame:
    """The same for each OWASP category, with its support; thinly supported ones fall back to the global weights."""
    known = rows.where("owasp_id IS NOT NULL")
    support = known.groupBy("suite_id", "owasp_id").agg(F.count("*").alias("support_clusters"), F.count_distinct("case_id").alias("support_cases"), F.sum("gt_overlap").alias("gt_positive_clusters"))
    found = with_weights(_hits(known, "suite_id", "owasp_id"), params).join(support, ["suite_id", "owasp_id"])
    return found.withColumns({"min_support_by_owasp": F.lit(params.min_support), "fallback_to_global": F.when(F.col("support_clusters") < params.min_support, 1).otherwise(0)})


def model(rows: DataFrame, params: CalibrationParams) -> DataFrame:
    """(suite_id, owasp_id, weights map): a row per supported category and one with a null category for all of the suite.

    Its size is bounded by ten categories a suite.
    """

    return as_model(global_weights(rows, params), weights_by_owasp(rows, params).where("fallback_to_global = 0"))


def as_model(whole: DataFrame, slices: DataFrame, keys: tuple[str, ...] = ("suite_id",)) -> DataFrame:
    """(keys, owasp_id, weights map) from the weights (tool, weight) of a whole and of its supported categories."""

    def as_map(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tool", "weight")))).alias("weights"))

    every = as_map(whole, *keys).select(*keys, F.lit(None).cast("string").alias("owasp_id"), "weights")
    return every.unionByName(as_map(slices, *keys, "owasp_id"))


def with_score(rows: DataFrame, weights: DataFrame, params: CalibrationParams, by_owasp: bool = True, name: str = "triage_score_v1", keys: tuple[str, ...] = ("suite_id",)) -> DataFrame:
    """rows (with keys, tools, tool_count, max_severity and owasp_id) and their score; a category's weights if it has any."""
    whole = weights.where("owasp_id IS NULL").select(*keys, F.col("weights").alias("_all"))
    out = rows.join(whole, list(keys), "left")
    if by_owasp:
        slices = weights.where("owasp_id IS NOT NULL").select(*keys, F.col("owasp_id").alias("_slice"), F.col("weights").alias("_own"))
        out = out.withColumn("_slice", owasp_id(F.col("owasp_id"))).join(slices, [*keys, "_slice"], "left")
    chosen = F.coalesce("_own", "_all") if by_owasp else F.col("_all")
    score = round6(triage_score(F.col("tools"), F.col("tool_count"), F.col("max_severity"), chosen, params))
    return out.withColumn(name, F.when(F.col("_all").isNotNull(), score)).drop("_all", "_own", "_slice")
