"""Classification, the finding contract, report tables, diagnostics and files on hand-made rows."""

import csv
from pathlib import Path

from pyspark.sql import functions as F

from siftwell.functions import contract
from siftwell.operators import compare, diagnostics, report, resolution
from siftwell.plans.catalog import suite
from siftwell.sinks import tables
from siftwell.sources.normalized import read_sonar_rules
from siftwell.sources.tables import read_csv, read_feature_tables

SF = "/root/testdata/sf0.001"


def test_candidates(spark):
    rows = spark.createDataFrame([(["79", "cwe:89", None], "about CWE_22 and CWE-079x", ["A03", "zz"], "OWASP A1, a10 and A11"), (None, None, None, None)], "ids array<string>, text string, codes array<string>, more string")
    found = rows.select(resolution.cwe_candidates([F.col("ids")], [F.col("text")]).alias("a"), resolution.vendor_codes([F.col("codes")], [F.col("more")]).alias("b")).collect()
    assert [tuple(r) for r in found] == [(["CWE-79", "CWE-89", "CWE-22"], ["A03", "A01", "A10"]), ([], [])]


def test_resolve(spark):
    mapping = spark.createDataFrame([("CWE-79", ["A7"], ["A3"]), ("CWE-22", ["A5"], ["A01", "A3"])], "cwe_id string, owasp_2017 array<string>, owasp_2021 array<string>")
    rows = [
        (1, ["CWE-22", "CWE-79"], ["A1:2017", "owasp A10"], ["A04"]),
        (2, ["CWE-79"], [], ["a4", "x"]),
        (3, [], ["A1:2017"], []),
        (4, None, None, None),
        (4, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, cwe_ids array<string>, owasp_tags array<string>, vendor_codes array<string>")
    found = resolution.resolve(df, mapping).orderBy("id").collect()
    codes = [[r[b] and r[b]["codes"] for b in contract.BLOCKS] for r in found]
    assert codes == [
        [["A5", "A7"], ["A1"], ["A5", "A7"], ["A10"], ["A10"], ["A01", "A03"]],
        [["A7"], None, ["A7"], ["A04"], ["A04"], ["A03"]],
        [["A1"], ["A1"], None, None, None, None],
        [None] * 6,
        [None] * 6,
    ]
    assert found[0]["cwe_id"] == "CWE-22" and found[0]["owasp_top_10_2021"]["categories"] == ["A10:2021-Server-Side Request Forgery (SSRF)"]
    assert resolution.resolve(df, mapping, use_2017_tags=False).where("owasp_top_10_2017_vendor IS NOT NULL").isEmpty()
    assert resolution.resolve(df.limit(0), mapping).isEmpty()


def test_rules(spark):
    rules = spark.createDataFrame([("r1", "Name", ["cwe-20", "cwe-x"], ["cwe:79", "owaspTop10:a1", "owaspTop10-2021:a3"]), ("r2", None, None, None)], "rule_key string, name string, tags array<string>, standards array<string>")
    known = resolution.rule_classification(rules)
    assert [(r["cwe_ids"], r["owasp_top_10_2017"] and r["owasp_top_10_2017"]["codes"], r["owasp_top_10_2021"] and r["owasp_top_10_2021"]["codes"]) for r in known.orderBy("rule_key").collect()] == [(["CWE-79", "CWE-20"], ["A1"], ["A03"]), ([], None, None)]
    findings = spark.createDataFrame([("r1", "", [], "old"), ("r2", "CWE-1", ["CWE-1"], "old"), (None, None, None, None)], "rule_id string, cwe_id string, cwe_ids array<string>, vuln_class string")
    found = resolution.enriched(findings, known).orderBy(F.col("rule_id").asc_nulls_last()).collect()
    assert [tuple(r)[:4] for r in found] == [("r1", "CWE-79", ["CWE-79", "CWE-20"], "Name"), ("r2", "CWE-1", ["CWE-1"], "old"), (None, None, None, None)]


def test_saved_rules(spark, tmp_path):
    texts = ['{"rule":{"key":"a","name":"N","tags":["cwe-7"],"securityStandards":["cwe:89","owaspTop10-2021:a3"]}}', '{"rule":{"key":"b","securityStandards":{"CWE":["79"],"OWASP Top 10 2017":["A7"],"other":1}}}', '{"errors":[]}', "no json"]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.json").write_text(text)
    known = resolution.rule_classification(read_sonar_rules(spark, str(tmp_path))).orderBy("rule_key").collect()
    assert [(r["rule_key"], r["vuln_class"], r["cwe_ids"]) for r in known] == [("a", "N", ["CWE-89", "CWE-7"]), ("b", None, ["CWE-79"])]
    assert known[0]["owasp_top_10_2021"]["codes"] == ["A03"] and known[1]["owasp_top_10_2017"]["codes"] == ["A7"]


def test_report_order(spark):
    rows = [("alerts", "x", "", "", None), ("tool_marginal", "m", "b", "s", 5), ("tool_marginal", "m", "b", "s", 1), ("new", "n", "", "", None), ("dataset", "d", "", "", None), ("policy", "p", "", "", None)]
    found = compare.ordered(spark.createDataFrame(rows, "section string, name string, tool string, strategy string, k int")).collect()
    assert [(r["section"], r["k"]) for r in found] == [("policy", None), ("dataset", None), ("tool_marginal", 1), ("tool_marginal", 5), ("new", None), ("alerts", None)]


def test_contract(spark):
    kind = "suite_id string, case_id string, tool string, finding_id string, rule_id string, title string, severity string, file_path string, line_number string, end_line_number string, cwe_ids array<string>"
    rows = [("s", "c", "t", "2", "r", "t", "LOW", "b", "3", None, ["CWE-9", None, "CWE-1"]), ("s", "c", "t", "1", "", None, "severe", "b", None, "x", None), ("s", "c", "t", "3", "r", "t", None, "a", "20", "20", []), ("s", "c", "t", "4", "r", "t", "", "b", "10", "10", [])]
    df = spark.createDataFrame(rows, kind)
    assert {r[0]: r[1] for r in df.select("finding_id", contract.problems()).collect()} == {"2": [], "1": ["missing:rule_id", "missing:title", "invalid:severity", "invalid:end_line_number"], "3": [], "4": []}
    found = contract.finalized(df).collect()
    assert [r["finding_id"] for r in found] == ["3", "1", "2", "4"]
    assert found[2]["cwe_ids"] == ["CWE-1", "CWE-9"]


def test_diagnostics(spark):
    runs = spark.createDataFrame([("s", "c1", "a"), ("s", "c1", "b"), ("s", "c2", "a")], "suite_id string, case_id string, tool string")
    assert [tuple(r) for r in diagnostics.empty_runs(runs, runs.limit(2)).collect()] == [("s", "c2", "a")]
    cases = spark.createDataFrame([("s", "c1", "main", "dev", "", "1"), ("s", "c2", "main", "main", "1", None)], "suite_id string, case_id string, expected_branch string, actual_branch string, expected_commit string, actual_commit string")
    assert sorted(tuple(r) for r in diagnostics.context_mismatches(cases).collect()) == [("s", "c1", "branch", "main", "dev"), ("s", "c2", "commit", "1", None)]
    receipts = spark.createDataFrame([("s", "a", "p", "h1"), ("s", "a", " p ", "h2"), ("s", " ", "q", "h3"), ("u", "a", None, "h1")], "suite_id string, tool string, profile string, config_hash string")
    one, two = diagnostics.scanner_config(receipts, ("b", "a")).orderBy("suite_id").collect()
    assert (one["profile"], one["profile_mode"], one["receipts_found"], one["tools_seen"], one["missing_tools"]) == ("p", "uniform", 3, ["a"], ["b"])
    assert one["warnings"] == ["missing config_receipt for tools: ['b']", "multiple config signatures detected for tools: ['a']"]
    assert (two["profile"], two["profile_mode"], two["warnings"]) == (None, "unknown", ["missing config_receipt for tools: ['b']"])


def test_filtered_to_zero(spark):
    planned = spark.createDataFrame([("s", "c1"), ("s", "c2")], "suite_id string, case_id string")
    runs = spark.createDataFrame([("s", "c1", "a"), ("s", "c1", "b")], "suite_id string, case_id string, tool string")
    flagged = spark.createDataFrame([("s", "c1", "a", True, False), ("s", "c1", "a", False, True)], "suite_id string, case_id string, tool string, is_in_mode boolean, is_in_scope boolean")
    clusters = spark.createDataFrame([], "suite_id string, case_id string, max_severity_rank int")
    matches = spark.createDataFrame([("s", "c2", True), ("s", "c2", False)], "suite_id string, case_id string, matched boolean")
    one, two = report.case_rows(planned, runs, flagged, clusters, matches, ("a", "b", "d")).orderBy("case_id").collect()
    assert (one["tools_used"], one["tools_missing"], one["empty_tools"], one["filtered_to_zero_tools"], one["findings"], one["findings_kept"], one["gap_total"]) == (["a", "b"], ["d"], ["b"], ["a"], 2, 0, None)
    assert (two["tools_used"], two["findings"], two["match_rate"], two["gap_total"], two["top_severity"]) == ([], 0, 0.5, 1, "")


def test_dataset(spark, tmp_path):
    heads = {"c1": ["case_id", "cluster_id", "x"], "c2": ["cluster_id", "schema_version", "suite_id"], "c3": ["case_id", "cluster_id", "x"]}
    rows = {"c1": [["", "b", "1"], ["", "a", "two\nlines, \"quoted\""], ["", "", ""]], "c2": [["z", "old", "own"]], "c3": []}
    for case, head in heads.items():
        folder = tmp_path / "cases" / case / "analysis"
        folder.mkdir(parents=True)
        with open(folder / "triage_features.csv", "w", newline="") as f:
            csv.writer(f).writerows([head, *rows[case]])
    parts = read_feature_tables(spark, f"{tmp_path}/cases/*/analysis/triage_features.csv")
    assert len(parts) == 2
    found = diagnostics.dataset(parts, "s", ["schema_version"])
    assert found.columns == ["suite_id", "case_id", "cluster_id", "schema_version", "x"]
    assert [tuple(r) for r in found.collect()] == [("s", "c1", "a", "triage_features_v1", 'two\nlines, "quoted"'), ("s", "c1", "b", "triage_features_v1", "1"), ("own", "c2", "z", "old", None)]


def test_written_tables(spark, tmp_path):
    df = spark.createDataFrame([(2, "b\n\"x\"", ["p", "q"]), (1, None, [])], "id int, text string, list array<string>")
    tables.write_table(df, f"{tmp_path}/t", ("parquet", "csv", "json"), ("id",))
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/t/parquet").collect()] == [1, 2]
    assert [tuple(r) for r in read_csv(spark, f"{tmp_path}/t/csv").collect()] == [("1", None, "[]"), ("2", 'b\n"x"', '["p","q"]')]
    tables.write_table(df.where("id = 2"), f"{tmp_path}/t", ("parquet",))
    assert spark.read.parquet(f"{tmp_path}/t/parquet").count() == 1


def test_suite_and_mart(spark, tmp_path):
    s = suite(spark, SF)
    manifest = tables.write_suite(s, f"{tmp_path}/out", ("clusters", "gt_score"), ("parquet", "csv"))
    assert [r["name"] for r in manifest.orderBy("name").collect()] == ["clusters", "gt_score"]
    assert spark.read.parquet(f"{tmp_path}/out/clusters/parquet").count() == s.clusters.count()
    assert spark.read.json(f"{tmp_path}/out/manifest/json").count() == 2
    for _ in range(2):  # a second write of the same run replaces the first
        names = tables.write_mart(s, f"{tmp_path}/mart", "bench")
    assert names == ["fact_eval_case_k", "fact_eval_suite_k", "fact_tool_value", "dim_suite_run", "dim_case"]
    assert spark.read.parquet(f"{tmp_path}/mart/fact_eval_case_k").count() == s.by_case.count()
    assert Path(f"{tmp_path}/mart/dim_suite_run/suite_run_id=suite_main").is_dir()
    runs = spark.createDataFrame([("suite_prev", "c", "semgrep", "r")], "suite_id string, case_id string, tool string, run_id string")
    earlier = suite(spark, SF, "suite_prev")
    tables.write_mart(earlier, f"{tmp_path}/mart", "bench", runs)  # another suite under the same root leaves the first one's rows
    for name, rows in (("fact_eval_case_k", (s.by_case, earlier.by_case)), ("dim_case", (s.cases, earlier.cases))):
        kept = {r["suite_run_id"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/mart/{name}").groupBy("suite_run_id").count().collect()}
        assert kept == {"suite_main": rows[0].count(), "suite_prev": rows[1].count()}
    assert spark.read.parquet(f"{tmp_path}/mart/dim_tool_run").columns == ["benchmark_id", "case_id", "tool", "run_id", "suite_run_id"]
