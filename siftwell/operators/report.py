"""What a suite's report shows: cases with their tools and counts, what needs action, where to look first, examples of hotspots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.scoring import ratio, round6
from siftwell.functions.severity import severity_rank
from siftwell.operators.groundtruth import CASE


def _tools(condition: Column) -> Column:
    """The tools of a case's rows that meet a condition, in order."""
    return F.array_sort(F.collect_set(F.when(condition, F.col("tool"))))


def case_rows(planned: DataFrame, runs: DataFrame, flagged: DataFrame, clusters: DataFrame, matches: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """One row per planned case (suite_id, case_id), whether it has results or not.

    runs: (suite_id, case_id, tool) of the reports that exist; flagged: findings with is_in_mode and is_in_scope.
    empty_tools have a report without findings, filtered_to_zero_tools findings of which none is kept.  gap_total is
    null where there is no ground truth.
    """
    kept = F.count_if(F.col("is_in_mode") & F.col("is_in_scope"))
    counts = flagged.groupBy(*CASE, "tool").agg(F.count("*").alias("n"), kept.alias("kept"))
    found = runs.select(*CASE, "tool").distinct().join(counts, [*CASE, "tool"], "left").fillna(0, ["n", "kept"])
    by_tool = found.groupBy(*CASE).agg(
        F.array_sort(F.collect_set("tool")).alias("tools_used"), _tools(F.col("n") == 0).alias("empty_tools"), _tools((F.col("n") > 0) & (F.col("kept") == 0)).alias("filtered_to_zero_tools"),
        F.sum("n").alias("findings"), F.sum("kept").alias("findings_kept"),
    )
    spots = clusters.groupBy(*CASE).agg(F.count("*").alias("clusters"), F.max("max_severity_rank").alias("top_rank"))
    truth = matches.groupBy(*CASE).agg(F.count("*").alias("gt_total"), F.count_if("matched").alias("gt_matched"))
    rows = planned.join(by_tool, CASE, "left").join(spots, CASE, "left").join(truth, CASE, "left")
    empty = F.array().cast("array<string>")
    rows = rows.withColumns({c: F.coalesce(c, empty) for c in ("tools_used", "empty_tools", "filtered_to_zero_tools")})
    rows = rows.fillna(0, ["findings", "findings_kept", "clusters", "gt_matched", "top_rank"])
    names = F.array(*map(F.lit, ("", "LOW", "MEDIUM", "HIGH")))
    return rows.select(
        *CASE, "tools_used", F.array_sort(F.array_except(F.array(*map(F.lit, tools)), "tools_used")).alias("tools_missing"), "empty_tools", "filtered_to_zero_tools", "findings", "findings_kept", "clusters",
        F.coalesce("gt_total", F.lit(0)).alias("gt_total"), "gt_matched", round6(ratio(F.col("gt_matched"), F.col("gt_total"))).alias("match_rate"),
        (F.col("gt_total") - F.col("gt_matched")).alias("gap_total"), F.get(names, F.col("top_rank").cast("int")).alias("top_severity"),
    )


def action_items(cases: DataFrame, by_owasp: DataFrame, examples: int = 3) -> DataFrame:
    """(suite_id, kind, subject, n, examples): what someone should look at; subject is a tool or an OWASP code, if any.

    Kinds: missing_outputs (no report, or none of a requested tool), no_clusters, empty_results and filtered_to_zero of
    a tool, below_min_support of a category.  n counts cases, or clusters for the last; examples are the first case ids.
    """
    def kind(name: str, subject: Column) -> Column:
        return F.struct(F.lit(name).alias("kind"), subject.alias("subject"))

    def if_true(condition: Column, name: str) -> Column:
        return F.when(condition, F.array(kind(name, F.lit("")))).otherwise(F.array().cast("array<struct<kind:string,subject:string>>"))

    found = F.concat(
        if_true((F.size("tools_used") == 0) | (F.size("tools_missing") > 0), "missing_outputs"), if_true(F.col("clusters") == 0, "no_clusters"),
        F.transform("empty_tools", lambda t: kind("empty_results", t)), F.transform("filtered_to_zero_tools", lambda t: kind("filtered_to_zero", t)),
    )
    each = cases.select("suite_id", "case_id", F.inline(found))
    first = F.row_number().over(Window.partitionBy("suite_id", "kind", "subject").orderBy("case_id"))
    shown = each.withColumn("_n", first).where(F.col("_n") <= examples).groupBy("suite_id", "kind", "subject").agg(F.array_sort(F.collect_list("case_id")).alias("examples"))
    total = each.groupBy("suite_id", "kind", "subject").agg(F.count("*").alias("n"))
    scarce = by_owasp.where("fallback_to_global = 1").select("suite_id", F.lit("below_min_support").alias("kind"), F.col("owasp_id").alias("subject"), F.col("support_clusters").cast("bigint").alias("n"), F.array().cast("array<string>").alias("examples")).distinct()
    return total.join(shown, ["suite_id", "kind", "subject"]).unionByName(scarce)


def pointers(cases: DataFrame, n: int = 3) -> DataFrame:
    """(suite_id, list, place, case_id, value): the n cases of each suite with most missed ground truth, and with the gravest findings."""
    by_gap = Window.partitionBy("suite_id").orderBy(F.desc("gap_total"), "case_id")
    by_severity = Window.partitionBy("suite_id").orderBy(F.desc(severity_rank(F.col("top_severity"))), F.desc("clusters"), "case_id")
    gap = cases.where("gap_total IS NOT NULL").select("suite_id", F.lit("gt_gap").alias("list"), F.row_number().over(by_gap).alias("place"), "case_id", F.col("gap_total").cast("string").alias("value"))
    grave = cases.select("suite_id", F.lit("severity").alias("list"), F.row_number().over(by_severity).alias("place"), "case_id", F.col("top_severity").alias("value"))
    return gap.where(F.col("place") <= n).unionByName(grave.where(F.col("place") <= n))


def drilldown(clusters: DataFrame, assigned: DataFrame, limit: int = 200, examples: int = 5) -> DataFrame:
    """The first clusters of each case by place, each with its first findings as examples.

    Both limits are ranks within a key, which Spark applies before it shuffles.
    """
    first = Window.partitionBy(*CASE).orderBy("file_path", F.coalesce("start_line", F.lit(0)), "cluster_id")
    top = clusters.select(*CASE, "cluster_id", "file_path", "start_line", "end_line", "tools", "tool_count", "max_severity", F.row_number().over(first).alias("place")).where(F.col("place") <= limit)
    order = Window.partitionBy(*CASE, "cluster_id").orderBy("item_seq", *[F.coalesce(c, F.lit("")) for c in ("tool", "rule_id", "title", "finding_id", "severity")])
    shown = assigned.select(*CASE, "cluster_id", "tool", "severity", "rule_id", "title", "finding_id", F.row_number().over(order).alias("_n")).where(F.col("_n") <= examples)
    listed = F.array_sort(F.collect_list(F.struct("_n", "tool", "severity", "rule_id", "title", "finding_id")))
    grouped = shown.groupBy(*CASE, "cluster_id").agg(listed.alias("examples"))
    without = F.transform("examples", lambda x: x.dropFields("_n"))
    return top.join(grouped, [*CASE, "cluster_id"], "left").withColumn("examples", without)


def scoreboard(queue: DataFrame, clusters: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """One row per case: the size of its queue, the most tools that agree, and the clusters of every tool."""
    per_tool = [F.count_if(F.array_contains("tools", t)).alias(f"{t}_clusters") for t in tools]
    top = queue.groupBy(*CASE).agg(F.count("*").alias("triage_items"), F.max(F.when(F.col("rank") == 1, F.col("tool_count"))).alias("top_agreement"))
    return top.join(clusters.groupBy(*CASE).agg(F.count_if(F.col("tool_count") > 1).alias("consensus_items"), *per_tool), CASE)


def benchmark_pack(queue: DataFrame, consensus: DataFrame, most: int = 200) -> DataFrame:
    """One row per case: the sizes and heads of its review and consensus queues, and their first rows in order.

    Ranks bound the lists before anything is collected.
    """

    def head(rows: DataFrame, size: str, top: str, items: str) -> DataFrame:
        entry = F.struct("rank", *[c for c in rows.columns if c not in (*CASE, "rank")])
        listed = F.array_sort(F.collect_list(F.when(F.col("rank") <= most, entry)), lambda a, b: a["rank"] - b["rank"])
        return rows.groupBy(*CASE).agg(F.count("*").alias(size), F.max(F.when(F.col("rank") == 1, F.col("tool_count"))).alias(top), listed.alias(items))

    both = head(queue, "triage_items", "top_agreement", "triage_queue_top").join(head(consensus, "consensus_items", "top_consensus", "consensus_queue_top"), CASE, "full_outer")
    return both.na.fill(0, ["triage_items", "top_agreement", "consensus_items", "top_consensus"])
