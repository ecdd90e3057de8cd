"""How far the tools agree on places in the code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.classification import codes_from_tags, normalize_cwe
from siftwell.functions.severity import severity_rank
from siftwell.operators.clustering import agreement_order, ranked

CASE = ["suite_id", "case_id"]


def location_matrix(clusters: DataFrame, tools: tuple[str, ...], *more: str) -> DataFrame:
    """Each cluster's place, size and number of findings by tool."""
    return clusters.select(*CASE, *more, "file_path", "start_line", "end_line", "cluster_id", F.array_join("tools", ",").alias("tools"), "tool_count", F.col("finding_count").alias("total_findings"), "max_severity", *[f"{t}_count" for t in tools])


def hotspot_matrix(clusters: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """The location matrix in the order of agreement, severity and size, with that place as a column."""
    placed = ranked(clusters, agreement_order(), name="place")
    return location_matrix(placed, tools, "place")


def consensus_level(tool_count: Column, total: Column | int) -> Column:
    return F.when(tool_count <= 0, "none").when(tool_count == 1, "single").when(tool_count == total, "unanimous").otherwise("multi")


def consensus_queue(clusters: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """Clusters ranked by agreement."""
    total = len(tools)
    return ranked(clusters, agreement_order()).select(
        *CASE, "rank", "file_path", "start_line", "end_line", "cluster_id", F.array_join("tools", ",").alias("tools"), "tool_count",
        (F.col("tool_count") / F.lit(total) if total else F.lit(0.0)).alias("agreement_fraction"), consensus_level(F.col("tool_count"), total).alias("consensus_level"),
        F.col("finding_count").alias("total_findings"), "max_severity", F.col("first_rule_id").alias("sample_rule_id"), F.col("first_title").alias("sample_title"),
    )


def consensus_summary(clusters: DataFrame) -> DataFrame:
    """Clusters of each case by number of tools."""
    return clusters.groupBy(*CASE, "tool_count").agg(F.count("*").alias("clusters"))


def pairwise_agreement(clusters: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """For each pair of tools (in the order given): clusters of either, of both, of any, and their Jaccard similarity.

    A cluster's few tools are paired within its row, so no join is needed and counts combine before the shuffle.
    """
    pairs = [(a, b) for k, a in enumerate(tools) for b in tools[k + 1 :]]
    marks = F.array(*[F.struct(F.lit(a).alias("tool_a"), F.lit(b).alias("tool_b"), F.array_contains("tools", a).alias("in_a"), F.array_contains("tools", b).alias("in_b")) for a, b in pairs])
    rows = clusters.select(*CASE, F.explode(marks).alias("p")).select(*CASE, "p.*")
    counted = rows.groupBy(*CASE, "tool_a", "tool_b").agg(
        F.count_if("in_a").alias("clusters_a"), F.count_if("in_b").alias("clusters_b"), F.count_if(F.col("in_a") & F.col("in_b")).alias("intersection"), F.count_if(F.col("in_a") | F.col("in_b")).alias("union")
    )
    return counted.withColumn("jaccard", F.bround(F.when(F.col("union") > 0, F.col("intersection") / F.col("union")).otherwise(0.0), 6))


def _case_tools(findings: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    return findings.select(*CASE).distinct().select(*CASE, F.explode(F.array(*map(F.lit, tools))).alias("tool"))


def tool_profile(findings: DataFrame, tools: tuple[str, ...]) -> DataFrame:
    """Findings, files, severities and issue types of each tool; a tool without findings has a row of zeros.

    types lists the issue types by count, then by their first finding.
    """
    label = F.upper(F.trim(F.coalesce("severity", F.lit(""))))
    totals = findings.groupBy(*CASE, "tool").agg(
        F.count("*").alias("findings"),
        F.count_distinct(F.when(F.col("file_path") != "", F.col("file_path"))).alias("files"),
        *[F.count_if(label == x.upper()).alias(x) for x in ("high", "medium", "low")],
        F.count_if(label == "").alias("unknown"),
    )
    kind = F.upper(F.trim("issue_type"))
    kinds = findings.where(kind != "").groupBy(*CASE, "tool", kind.alias("kind")).agg(F.count("*").alias("n"), F.min("item_seq").alias("first"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "first", "kind")))
    types = kinds.groupBy(*CASE, "tool").agg(F.array_join(F.transform(listed, lambda x: F.concat(x["kind"], F.lit(":"), (-x["order"]).cast("string"))), ",").alias("types"))
    rows = _case_tools(findings, tools).join(totals, [*CASE, "tool"], "left").join(types, [*CASE, "tool"], "left")
    return rows.na.fill(0, ["findings", "files", "high", "medium", "low", "unknown"]).na.fill("", ["types"])


def overview_files(kept: DataFrame) -> DataFrame:
    """Each file's tools and their numbers of findings; files of more tools first."""
    counts = kept.where("file_path <> ''").groupBy(*CASE, "file_path", "tool").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("tool", "n")))
    return counts.groupBy(*CASE, "file_path").agg(pairs.alias("pairs")).select(
        *CASE, "file_path", F.array_join(F.transform("pairs", lambda p: p["tool"]), ",").alias("tools"), F.size("pairs").alias("tool_count"),
        F.array_join(F.transform("pairs", lambda p: F.concat(p["tool"], F.lit(":"), p["n"].cast("string"))), ",").alias("finding_counts"),
    )


def overview_tools(in_mode: DataFrame, kept: DataFrame) -> DataFrame:
    """For each tool: findings after the mode filter alone, files in scope, and those that no other tool has."""
    files = kept.where("file_path <> ''").select(*CASE, "file_path", "tool").distinct()
    alone = F.count("*").over(Window.partitionBy(*CASE, "file_path")) == 1
    per_tool = files.withColumn("alone", alone).groupBy(*CASE, "tool").agg(F.count("*").alias("files"), F.count_if("alone").alias("unique_files"))
    return in_mode.groupBy(*CASE, "tool").agg(F.count("*").alias("findings")).join(per_tool, [*CASE, "tool"], "left").na.fill(0, ["files", "unique_files"])


def unique_files(kept: DataFrame) -> DataFrame:
    """Files that one tool alone has findings in."""
    files = kept.where("file_path <> ''").groupBy(*CASE, "file_path").agg(F.min("tool").alias("tool"), F.max("tool").alias("last"))
    return files.where("tool = last").select(*CASE, "tool", "file_path")


def classified(findings: DataFrame, cwe_owasp: DataFrame) -> DataFrame:
    """findings with cwe (its first one, normalised) and codes: the 2021 codes of all its CWEs, else those its vendor's tags, rule and title name.

    cwe_ids and owasp_tags are lists that findings may lack.
    """
    none = F.array().cast("array<string>")
    cwe_ids, tags = (F.coalesce(c, none) if c in findings.columns else none for c in ("cwe_ids", "owasp_tags"))
    cwes = F.array_distinct(F.array_compact(F.transform(F.concat(F.array("cwe_id"), cwe_ids), normalize_cwe)))
    codes = cwe_owasp.where("cwe_id IS NOT NULL AND owasp_2021 IS NOT NULL").groupBy("cwe_id").agg(F.flatten(F.collect_list("owasp_2021")).alias("codes"))
    named = findings.withColumn("_cwes", cwes)
    # the few distinct lists of CWEs meet the catalogue, not the findings
    lists = named.select("_cwes").distinct().select("_cwes", F.posexplode("_cwes").alias("pos", "cwe_id")).join(codes, "cwe_id")
    known = lists.groupBy("_cwes").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "codes"))), lambda x: x["codes"]))).alias("_known"))
    named = named.join(known, "_cwes", "left")
    canonical = F.coalesce("_known", none)
    vendor = codes_from_tags(F.array_compact(F.concat(tags, F.array("rule_id", "title"))), 2021)
    return named.withColumn("cwe", F.get("_cwes", F.lit(0))).withColumn("codes", F.when(F.size(canonical) > 0, canonical).otherwise(vendor)).drop("_cwes", "_known")


def taxonomy(findings: DataFrame, cwe_owasp: DataFrame) -> DataFrame:
    """Findings of each tool by OWASP 2021 code; a finding with several codes counts once for each."""
    rows = classified(findings, cwe_owasp).select(*CASE, "tool", F.when(F.size("codes") > 0, F.col("codes")).otherwise(F.array(F.lit("UNCLASSIFIED"))).alias("codes"))
    totals = findings.groupBy(*CASE, "tool").agg(F.count("*").alias("tool_total_findings"))
    counts = rows.select(*CASE, "tool", F.explode("codes").alias("owasp_2021_code")).groupBy(*CASE, "tool", "owasp_2021_code").agg(F.count("*").alias("count"))
    return counts.join(totals, [*CASE, "tool"])


def severity_totals(findings: DataFrame) -> DataFrame:
    """A scan's header and counts: findings by tool and severity rank."""
    return findings.groupBy(*CASE, "tool").agg(F.count("*").alias("findings"), *[F.count_if(severity_rank(F.col("severity")) == r).alias(n) for n, r in (("high", 3), ("medium", 2), ("low", 1), ("other", 0))])
