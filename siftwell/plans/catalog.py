"""The registered queries over the adapter views, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions import classification, contract, paths, severity
from siftwell.operators import agreement, clustering, compare, diagnostics, evaluation, filters, groundtruth, mart, report, resolution, tolerance
from siftwell.plans.suite import Suite
from siftwell.sources import adapters, case_lists, catalogs, layout, lines, manifests, normalized, provenance, vendor_rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BENCHMARK = "benchmark"
CASE = ["suite_id", "case_id"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def suite(spark: SparkSession, sf_dir: str, name: str = "suite_main") -> Suite:
    return Suite(adapters.findings(spark, sf_dir, name), adapters.ground_truth(spark, sf_dir, name), lean=True)


def of_suite(name: str, make: Callable[[Suite], DataFrame]) -> None:
    """Register a query that is a table of the main suite."""
    QUERIES[name] = lambda spark, sf_dir: make(suite(spark, sf_dir))


@query
def normalize_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_paths(spark, sf_dir)
    path = paths.normalize_file_path(F.col("raw_path"), "repo")
    return rows.select("case_id", "tool", "l_orderkey", "l_linenumber", "raw_path", path.alias("file_path"), paths.as_prefix(F.col("raw_path")).alias("as_prefix"))


@query
def location_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.findings(spark, sf_dir)
    return rows.groupBy(paths.location_key(F.col("file_path"), F.col("line_number"), F.col("end_line_number")).alias("location_key")).agg(F.count("*").alias("findings"))


@query
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.latest_runs(adapters.tool_runs(spark, sf_dir), ["case_id", "tool"])


@query
def severity_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get(F.array(*map(F.lit, adapters.SEVERITIES)), F.pmod("o_custkey", F.lit(len(adapters.SEVERITIES))).cast("int"))
    words = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.regexp_extract("o_orderpriority", "([A-Z]+)", 1).alias("word"), raw.alias("raw")).distinct()
    return words.select(
        "word", "raw", severity.severity_rank(F.col("word")).alias("rank"), severity.report_rank(F.when(F.col("word") == "URGENT", "critical").otherwise(F.col("word"))).alias("report_rank"),
        severity.semgrep_severity(F.col("raw")).alias("semgrep"), severity.sarif_severity(F.when(F.col("word") == "URGENT", "error").otherwise(F.col("word"))).alias("sarif"),
        severity.sonar_severity(F.when(F.col("word") == "HIGH", "MAJOR").otherwise(F.col("word"))).alias("sonar"), severity.generic_severity(F.col("raw")).alias("generic"), severity.generic_severity(F.col("raw"), "aikido").alias("aikido"),
    )


@query
def cwe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.findings(spark, sf_dir)
    return rows.groupBy("cwe_id", classification.normalize_cwe(F.col("cwe_id")).alias("cwe")).agg(F.count("*").alias("findings"))


of_suite("filter_mode", lambda s: filters.by_mode(s.findings, "security").groupBy(*CASE, "tool", "issue_type").agg(F.count("*").alias("findings")))
of_suite("filter_scope", lambda s: s.items.groupBy(*CASE, "file_path").agg(F.count("*").alias("findings")))
of_suite("filter_counts", lambda s: filters.filter_counts(s.findings, s.config))
of_suite("severity_totals", lambda s: agreement.severity_totals(s.items))
of_suite("cluster_locations", lambda s: s.clusters.select(*clustering.CLUSTER, F.array_join("tools", ",").alias("tools"), "tool_count", "finding_count", "max_severity"))
of_suite("location_matrix", lambda s: agreement.location_matrix(s.clusters, s.config.tools))
of_suite("hotspot_matrix", lambda s: agreement.hotspot_matrix(s.clusters, s.config.tools))
of_suite("overview_files", lambda s: agreement.overview_files(s.items))
of_suite("overview_tools", lambda s: agreement.overview_tools(s.in_mode, s.items))
of_suite("unique_files", lambda s: agreement.unique_files(s.items))
of_suite("tool_profile", lambda s: agreement.tool_profile(s.items, s.config.tools))
of_suite("pairwise_agreement", lambda s: agreement.pairwise_agreement(s.clusters, s.config.tools))
of_suite("consensus_queue", lambda s: agreement.consensus_queue(s.clusters, s.config.tools))
of_suite("consensus_summary", lambda s: agreement.consensus_summary(s.clusters))


@query
def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.taxonomy(suite(spark, sf_dir).items, adapters.cwe_owasp(spark))


of_suite("gt_match", lambda s: s.matches)
of_suite("gt_summary", lambda s: groundtruth.match_summary(s.matches))
of_suite("gt_summary_by_set", lambda s: groundtruth.match_summary(s.matches, "set_name"))
of_suite("gt_summary_by_track", lambda s: groundtruth.match_summary(s.matches, "track"))
of_suite("gt_track_sast", lambda s: groundtruth.match_summary(groundtruth.match_items(filters.by_track(s.gt, "SAST"), s.items, 0)))
of_suite("gt_tool_recall", lambda s: groundtruth.tool_recall(s.matches))
of_suite("gt_gap_queue", lambda s: s.gaps)
of_suite("gt_gap_summary", lambda s: groundtruth.gap_summary(s.gaps, s.matches))
of_suite("gt_set_scores", lambda s: groundtruth.set_scores(s.gt.select(*CASE, "file", F.col("start_line").alias("line")), s.items.select(*CASE, F.col("file_path").alias("file"), F.coalesce("line_number", F.lit(0)).alias("line")), ["file", "line"], CASE))
of_suite("triage_queue_baseline", lambda s: s.queue.drop("triage_score_v1"))
of_suite("triage_queue_calibrated", lambda s: s.calibrated_queue)
of_suite("triage_features", lambda s: s.features.drop("generated_at"))
of_suite("calibration_global", lambda s: s.weights)
of_suite("calibration_by_owasp", lambda s: s.weights_by_owasp)
of_suite("suspicious_cases", lambda s: filters.suspicious_cases(s.features, s.gt))
for _strategy in evaluation.STRATEGIES:
    of_suite(f"rank_{_strategy}", lambda s, x=_strategy: evaluation.rankings(s.rows, s.model, s.config, max(s.config.ks), strategies=(x,)).select(*CASE, "strategy", "rank", "cluster_id", "triage_score_v1"))
of_suite("eval_cases", lambda s: evaluation.classify_cases(s.cases))
of_suite("eval_topk", lambda s: s.topk)
of_suite("eval_by_case", lambda s: s.by_case)
of_suite("eval_macro", lambda s: s.macro)
of_suite("eval_micro", lambda s: s.micro)
of_suite("eval_macro_from_topk", lambda s: s.macro_from_topk.withColumns({m: F.bround(m, 6) for m in ("precision", "gt_coverage")}))
of_suite("eval_deltas", lambda s: evaluation.deltas_by_case(s.by_case))
of_suite("eval_suite_deltas", lambda s: evaluation.deltas_of_suite(s.macro))
of_suite("eval_topk_focus", lambda s: evaluation.topk_focus(s.macro, s.micro))
of_suite("tool_utility", lambda s: s.utility)
of_suite("tool_marginal", lambda s: s.marginal)
of_suite("tolerance_sweep", lambda s: tolerance.sweep(s.near, s.gt, s.config.gt_tolerance_candidates))
of_suite("tolerance_auto", lambda s: tolerance.select_tolerance(tolerance.sweep(s.near, s.gt, s.config.gt_tolerance_candidates)))
of_suite("tolerance_by_case", lambda s: tolerance.sweep_cases(s.near, s.gt, s.config.gt_tolerance_candidates))
of_suite("gt_ambiguity", lambda s: tolerance.warnings(tolerance.sweep(s.near, s.gt, (3,))).select("suite_id", "gt_tolerance", F.array_join("warnings", ";").alias("warnings")))
of_suite("dataset_counts", lambda s: compare.dataset_counts(s.rows))
of_suite("clusters_by_tool", lambda s: compare.clusters_by_tool(s.rows))
of_suite("mart_fact_eval_case_k", lambda s: mart.fact_eval_case_k(s.by_case, BENCHMARK))
of_suite("mart_fact_eval_suite_k", lambda s: mart.fact_eval_suite_k(s.macro, s.micro, BENCHMARK))
of_suite("mart_fact_tool_value", lambda s: mart.fact_tool_value(s.utility, s.marginal, BENCHMARK))
of_suite("mart_dim_case", lambda s: mart.dim_case(s.cases, BENCHMARK).drop("suite_run_id"))
of_suite("mart_dim_suite_run", lambda s: mart.dim_suite_run(s.findings, BENCHMARK, s.config.tolerance, s.config.gt_tolerance, s.config.mode))


def _long(s: Suite) -> DataFrame:
    return compare.long_table(compare.dataset_counts(s.rows), s.macro, s.micro, s.weights, s.weights_by_owasp, s.utility)


@query
def suite_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift from the earlier run to the present one."""
    return compare.compared(_long(suite(spark, sf_dir, "suite_prev")), _long(suite(spark, sf_dir)))


@query
def mart_strategy_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage at 25 by case, calibrated minus baseline, as SQL over the mart."""
    facts = mart.fact_eval_case_k(suite(spark, sf_dir).by_case, BENCHMARK)
    return spark.sql(
        """SELECT case_id, max(CASE WHEN strategy = 'calibrated' THEN coverage_at_k END) - max(CASE WHEN strategy = 'baseline' THEN coverage_at_k END) AS delta_coverage
        FROM {facts} WHERE k = 25 GROUP BY case_id""",
        facts=facts,
    )


of_suite("tolerance_tools", lambda s: s.tolerance_tools)
of_suite("tolerance_macro", lambda s: s.tolerance_macro)
of_suite("tolerance_report", lambda s: s.tolerance_report)


def _joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name.split(".")[0])


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.tagged(spark, sf_dir)
    ids = resolution.cwe_candidates([F.array("cwe_id")], [F.col("description")])
    return resolution.resolve(rows.withColumns({"cwe_ids": ids, "vendor_codes": resolution.vendor_codes([F.col("vendor_field")], [])}), adapters.cwe_mapping(spark))


@query
def finding_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by their CWE ids and the six views of their OWASP codes."""
    rows = _classified(spark, sf_dir).select("tool", "cwe_id", _joined("cwe_ids"), *[_joined(f"{b}.codes") for b in contract.BLOCKS])
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("findings"))


@query
def finalized_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.finalized(_classified(spark, sf_dir)).select(*CASE, "tool", "finding_id", "file_path", "line_number", _joined("cwe_ids"))


@query
def finding_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.flawed(spark, sf_dir).select("tool", F.explode(contract.problems()).alias("problem"))
    return rows.groupBy("tool", "problem").agg(F.count("*").alias("findings"))


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.rule_classification(adapters.rules(spark, sf_dir))


@query
def rule_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).select("rule_key", "vuln_class", _joined("cwe_ids"), _joined("owasp_top_10_2017.codes"), _joined("owasp_top_10_2021.codes"))


@query
def rule_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sonar's findings with what their rules add."""
    rows = adapters.findings(spark, sf_dir).where("tool = 'sonar'").withColumns({"cwe_ids": F.array().cast("array<string>"), "vuln_class": F.lit("own")})
    found = resolution.enriched(rows, _rules(spark, sf_dir)).select("rule_id", "cwe_id", _joined("cwe_ids"), "vuln_class", _joined("owasp_top_10_2021.codes"))
    return found.groupBy(*found.columns).agg(F.count("*").alias("findings"))


@query
def payload_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CWE ids, OWASP codes and tags of payloads without a schema."""
    rows = adapters.payloads(spark, sf_dir).select("o_orderkey", F.col("o_orderkey").cast("string").alias("path"), F.lit(0).alias("pos"), F.try_parse_json("payload").alias("r"))
    found = normalized.with_roles(rows, F.col("r"), "aikido")
    ids = resolution.cwe_candidates([F.col("cwe_fields"), F.col("weakness_fields")], [], F.col("cwe_texts"))
    codes = resolution.vendor_codes([F.col("owasp_fields")], [], F.col("owasp_texts"))
    return found.select("o_orderkey", F.array_join(ids, ",").alias("cwe_ids"), F.array_join(codes, ",").alias("vendor_codes"), F.array_join("tags", "|").alias("tags"))


@query
def vendor_rule_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_rules.rule_index(adapters.vendor_files(spark, sf_dir)).select("rule_key", _joined("owasp_codes"), _joined("cwe_ids"))


@query
def vendor_rule_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with what mapping files say of their rule, looked up by id, then by name."""
    found = vendor_rules.with_vendor_rules(adapters.named_rules(spark, sf_dir), vendor_rules.rule_index(adapters.vendor_files(spark, sf_dir)))
    return found.groupBy("rule_id", "rule_name", _joined("rule_owasp_codes"), _joined("rule_cwe_ids")).agg(F.count("*").alias("findings"))


@query
def mart_dim_tool_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.dim_tool_run(provenance.tool_runs(adapters.run_documents(spark, sf_dir)), BENCHMARK)


@query
def config_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.receipts(adapters.run_documents(spark, sf_dir))


@query
def line_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of each file that a finding in it points at."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    findings = orders.select(F.concat(F.lit("src/o"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias("path"), (F.col("o_custkey") % 7).alias("line"))
    return findings.join(lines.numbered_lines(adapters.source_lines(spark, sf_dir)), ["path", "line"], "left").select("path", "line", "content")


@query
def gt_source_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of ground truth that each case takes, or why it takes none."""
    cases = adapters.gt_cases(spark, sf_dir)
    scanned = cases.where("shape = 6").select(*CASE, F.parse_json(F.lit('{"id": "s"}')).alias("item"))
    found = catalogs.documents(adapters.catalogs(spark, sf_dir))
    return catalogs.choices(cases, found, scanned).select(*CASE, "gt_source_mode", "gt_source_used", "reason", "n_items")


@query
def case_lists_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of lists with and without headers."""
    return case_lists.cases_of(adapters.case_rows(spark, sf_dir)).select("list", "place", "case_id", "runs_repo_name", "label", "repo_path", "repo_key", "branch", "track", "tags_json")


@query
def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per case of a suite, from the manifests of its cases."""
    return manifests.case_summary(manifests.case_manifests(adapters.manifests(spark, sf_dir)))


@query
def schema_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.schema_gaps(adapters.flawed(spark, sf_dir))


@query
def empty_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.empty_runs(adapters.reports(spark, sf_dir), adapters.findings(spark, sf_dir))


@query
def scanner_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = adapters.receipts(spark, sf_dir).unionByName(adapters.receipts(spark, sf_dir, "suite_prev"))
    hashes = F.array_join(F.transform("config_hashes", lambda x: F.concat(x["tool"], F.lit("="), F.array_join(x["hashes"], ","))), ";")
    rows = diagnostics.scanner_config(both, ("semgrep", "snyk", "sonar", "aikido"))
    return rows.select("suite_id", "profile", "profile_mode", hashes.alias("config_hashes"), "receipts_found", _joined("tools_seen"), _joined("missing_tools"), F.array_join("warnings", "; ").alias("warnings"))


def _cases(s: Suite, sf_dir: str) -> DataFrame:
    spark = s.findings.sparkSession
    return s.case_rows(adapters.planned(spark), adapters.reports(spark, sf_dir))


@query
def case_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cases(suite(spark, sf_dir), sf_dir)
    return rows.withColumns({c: F.array_join(c, ",") for c in ("tools_used", "tools_missing", "empty_tools", "filtered_to_zero_tools")})


@query
def action_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suite(spark, sf_dir)
    return report.action_items(_cases(s, sf_dir), s.weights_by_owasp).withColumn("examples", F.array_join("examples", ","))


@query
def report_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.pointers(_cases(suite(spark, sf_dir), sf_dir))


def _drilldown(s: Suite) -> DataFrame:
    fields = ("tool", "severity", "rule_id", "title", "finding_id")
    shown = F.array_join(F.transform("examples", lambda x: F.concat_ws(":", *[F.coalesce(x[f], F.lit("")) for f in fields])), ";")
    return report.drilldown(s.clusters, s.assigned).withColumns({"examples": shown, "tools": F.array_join("tools", ",")})


of_suite("hotspot_drilldown", _drilldown)


def _pack(s: Suite) -> DataFrame:
    found = report.benchmark_pack(s.queue, agreement.consensus_queue(s.clusters, s.config.tools))
    shown = {c: F.array_join(F.transform(c, lambda x: F.concat_ws("@", x["rank"].cast("string"), x["cluster_id"])), ";") for c in ("triage_queue_top", "consensus_queue_top")}
    return found.withColumns(shown)


of_suite("benchmark_pack", _pack)
of_suite("scoreboard", lambda s: report.scoreboard(s.queue, s.clusters, s.config.tools))


@query
def dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned cases, of which one has no table, two have an empty one and one has rows of another schema version."""
    features = suite(spark, sf_dir).features.where("case_id NOT IN ('owasp2021-a09-case', 'owasp2021-a10-case')")
    older = (F.col("case_id") == "owasp2021-a02-case") & (F.col("triage_rank") > 1)
    features = features.withColumn("schema_version", F.when(older, "triage_features_v0").otherwise(F.col("schema_version")))
    tables = adapters.planned(spark).where("case_id NOT IN ('owasp2021-a10-case', 'owasp2021-a12-case')")
    return diagnostics.dataset_audit(adapters.planned(spark), tables, features)
