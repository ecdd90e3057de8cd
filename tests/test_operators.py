"""Operators on hand-made rows whose results are known."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig, CalibrationParams
from siftwell.functions import classification, parsing, paths, severity
from siftwell.operators import agreement, calibration, clustering, compare, evaluation, filters, groundtruth, tolerance
from siftwell.plans.suite import Suite
from siftwell.sources import layout

ITEM = "suite_id string, case_id string, tool string, finding_id string, rule_id string, title string, severity string, issue_type string, file_path string, line_number int, end_line_number int, item_seq long"


def items(spark, places):
    """places: (tool, file, line, end, severity)."""
    return spark.createDataFrame([("s", "c", t, f"F{k}", f"R{k % 3}", f"T{k % 2}", sev, "", f, a, b, k) for k, (t, f, a, b, sev) in enumerate(places)], ITEM)


def column(spark, values, kind, make):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(make(F.col("v"))).collect()]


def test_paths(spark):
    given = ["/work/Repo/./src//f.py", "./src/f.py", "C:\\x\\repo\\src\\f.py", "/tmp/repo/repo/src/f.py", "  /a//b ", "", None, "repo/x"]
    assert column(spark, given, "string", lambda c: paths.normalize_file_path(c, "repo")) == ["src/f.py", "src/f.py", "src/f.py", "src/f.py", "a/b", "", "", "repo/x"]
    assert paths.exclude_prefixes(["./benchmark/", "benchmark", "", "a//b"]) == ["benchmark", "a/b"]
    assert column(spark, ["benchmark", "benchmark/x", "benchmarks/x", ""], "string", lambda c: paths.is_excluded(c, ["benchmark/"])) == [True, True, False, False]
    assert column(spark, ["a/b", "../b", "a/../b", "/a"], "string", paths.safe_path) == ["a/b", None, None, None]


def test_labels(spark):
    assert column(spark, ["CWE-79", "cwe:89", "22", "CWE 502", "x", None, "0"], "string", classification.normalize_cwe) == ["CWE-79", "CWE-89", "CWE-22", "CWE-502", None, None, None]
    assert column(spark, ["owasp2021-a03-case", "x-A7-y", "none", "owasp2021-a11-x"], "string", lambda c: classification.infer_owasp(c)) == ["A03", "A07", None, None]
    tags = [["OWASP-A03:2021 - Injection", "owasp2017-a1"], ["A1:2017"], ["a4"]]
    assert column(spark, tags, "array<string>", lambda c: classification.codes_from_tags(c, 2021)) == [["A03"], [], []]
    assert column(spark, tags, "array<string>", lambda c: classification.codes_from_tags(c, 2017)) == [["A1"], ["A1"], []]
    assert column(spark, ["high", " LOW ", "CRITICAL", None], "string", severity.severity_rank) == [3, 1, 0, 0]
    assert column(spark, ["9.8", "5", "0", "moderate", "?", None], "string", severity.generic_severity) == ["HIGH", "MEDIUM", None, "MEDIUM", None, None]


def test_cells(spark):
    assert column(spark, ["12", "12.0", " 12 ", None], "string", parsing.to_int) == [12, None, 12, None]
    assert column(spark, ["1.9", "", "x", None], "string", parsing.cell_int) == [1, 0, 0, 0]
    assert column(spark, ['["a","b"]', "[]", None], "string", lambda c: parsing.parse_tools(c, F.lit("x, y"))) == [["a", "b"], ["x", "y"], ["x", "y"]]
    assert parsing.parse_candidates("0, 1;1 5") == [0, 1, 5] and parsing.normalize_ks([5, 0, 1]) == [1, 5]


def swept(places, tol):
    """The reference result: one pass over each file's findings in line order."""
    found = {}
    for name in {p[1] for p in places}:
        ranges = []
        for _, f, a, b, _ in sorted((p for p in places if p[1] == name and p[2] and p[2] > 0), key=lambda p: p[2]):
            b = a if b is None else b
            if ranges and a <= ranges[-1][1] + tol:
                ranges[-1][1] = max(ranges[-1][1], b)
                ranges[-1][2] += 1
            else:
                ranges.append([a, b, 1])
        for a, b, n in ranges:  # reversed ranges may share an id
            found[f"{name}:{a}-{b}"] = found.get(f"{name}:{a}-{b}", 0) + n
        if lost := sum(p[1] == name and not (p[2] and p[2] > 0) for p in places):
            found[f"{name}:unknown"] = lost
    return found


def test_clusters_equal_a_sweep(spark):
    rng = random.Random(3)
    for tol in (0, 3):
        places = []
        for _ in range(400):
            a = rng.choice([None, 0, *[rng.randint(1, 120)] * 8])
            places.append((rng.choice("abcd"), rng.choice(["x", "y", "z"]), a, rng.choice([None, (a or 0) + rng.randint(-2, 6)]), "LOW"))
        got = clustering.assign_clusters(items(spark, places), tol).groupBy("cluster_id").count().collect()
        assert {r["cluster_id"]: r["count"] for r in got} == swept(places, tol)
    assert clustering.assign_clusters(items(spark, [("a", "x", 1, 1, "LOW")]).limit(0), 3).count() == 0


def test_cluster_summary_and_agreement(spark):
    rows = items(spark, [("b", "x", 5, 6, "low"), ("a", "x", 6, None, "HIGH"), ("a", "x", 8, 8, None), ("c", "y", None, None, "MEDIUM")])
    clusters = clustering.summarize_clusters(clustering.assign_clusters(rows, 3), ("a", "b", "c"))
    got = {r["cluster_id"]: r for r in clusters.collect()}
    one = got["x:5-8"]
    assert (one["tools"], one["finding_count"], one["max_severity"], one["sample"]["tool"], one["a_count"], one["severity_unknown_count"]) == (["a", "b"], 3, "HIGH", "a", 2, 1)
    assert got["y:unknown"]["start_line"] is None
    pairs = {(r["tool_a"], r["tool_b"]): r["jaccard"] for r in agreement.pairwise_agreement(clusters, ("a", "b", "c")).collect()}
    assert pairs == {("a", "b"): 1.0, ("a", "c"): 0.0, ("b", "c"): 0.0}
    levels = [r["consensus_level"] for r in agreement.consensus_queue(clusters, ("a", "b")).collect()]
    assert sorted(levels) == ["single", "unanimous"]


def test_filters(spark):
    rows = items(spark, [("sonar", "benchmark/x", 1, 1, "LOW"), ("semgrep", "src/x", 1, 1, "LOW"), ("sonar", "src/x", 1, 1, "LOW")])
    assert [r["tool"] for r in filters.selected(rows, AnalysisConfig()).collect()] == ["semgrep"]
    assert filters.selected(rows, AnalysisConfig(mode="all")).count() == 2


def test_ground_truth(spark):
    raw = spark.createDataFrame([("s", "c", None, "./x", "9", "5", "SAST"), ("s", "c", "g2", "y", "1", None, None), ("s", "c", "g3", "", "1", None, None)], "suite_id string, case_id string, id string, file string, line string, end string, track string")
    gt = groundtruth.normalize_items(raw)
    got = {r["gt_id"]: (r["start_line"], r["end_line"], r["track"]) for r in gt.collect()}
    assert got == {"gt:x:5:9": (5, 9, "sast"), "g2": (1, 1, "unknown")}
    found = items(spark, [("a", "x", 10, 10, "LOW"), ("b", "y", 9, 9, "LOW")])
    assert {r["gt_id"]: r["matched_tools"] for r in groundtruth.match_items(gt, found, 1).collect()} == {"gt:x:5:9": "a", "g2": ""}
    gaps = groundtruth.gap_queue(groundtruth.match_items(gt, found, 0), found.selectExpr("*", "true AS is_in_mode", "false AS is_in_scope"))
    assert {r["gt_id"]: (r["reason"], r["filtered_by"]) for r in gaps.collect()} == {"gt:x:5:9": ("filtered_out", "scope"), "g2": ("filtered_out", "scope")}
    stats = tolerance.sweep(clustering.summarize_clusters(clustering.assign_clusters(found, 3), ("a", "b")), gt, (0, 1, 10))
    assert {r["gt_tolerance"]: r["gt_overlap_1"] for r in stats.collect()} == {0: 0, 1: 1, 10: 2}
    assert tolerance.select_tolerance(stats, 0.5).first()["selected_gt_tolerance"] == 1
    assert tolerance.effective_tolerance(None, 2, 5) == (2, "suite")


FEATURE = "suite_id string, case_id string, cluster_id string, owasp_id string, tools_json string, tools string, tool_counts_json string, tool_count int, finding_count long, max_severity string, max_severity_rank int, file_path string, start_line int, triage_rank int, gt_overlap int, gt_overlap_ids_json string, gt_overlap_ids string"


def feature(case, cluster, tools, rank, place, triage, ids):
    file, line = place.split(":")
    return ("s", case, cluster, "A01", None, ",".join(tools), None, len(tools), len(tools), {3: "HIGH", 2: "MEDIUM"}[rank], rank, file, int(line), triage, int(bool(ids)), None, ";".join(ids))


def gt_of(spark, ids):
    return spark.createDataFrame([("s", c, g) for c, g in ids], "suite_id string, case_id string, gt_id string")


def test_evaluation(spark):
    table = spark.createDataFrame(
        [feature("one", "c2", ["snyk"], 3, "a.py:10", 1, []), feature("one", "c1", ["semgrep", "snyk"], 3, "b.py:20", 2, ["GT-1"]), feature("one", "c3", ["semgrep"], 2, "c.py:30", 3, ["GT-2"]), feature("two", "c1", ["sonar"], 3, "x.py:1", 1, ["GT-3"])], FEATURE
    )
    config = AnalysisConfig(ks=(1, 3))
    rows, gt = evaluation.read_features(table), gt_of(spark, [("one", "GT-1"), ("one", "GT-2"), ("two", "GT-3")])
    cases = evaluation.cases(rows, gt)
    by_case = evaluation.by_case(evaluation.rankings(rows, None, config, 3), cases, config, ("baseline", "agreement"))
    macro = {(r["strategy"], r["k"]): (r["precision"], r["gt_coverage"]) for r in evaluation.macro(by_case).collect()}
    micro = {(r["strategy"], r["k"]): (r["precision"], r["gt_coverage"]) for r in evaluation.micro(by_case).collect()}
    assert macro["baseline", 1] == (0.5, 0.5) and micro["baseline", 1] == (0.5, 0.333333)
    assert macro["agreement", 1] == (1.0, 0.75) and micro["agreement", 1] == (1.0, 0.666667)
    utility = {r["tool"]: (r["gt_ids_covered"], r["unique_gt_ids"], r["neg_clusters"]) for r in evaluation.tool_utility(rows, cases).collect()}
    assert utility == {"semgrep": (2, 1, 0), "snyk": (1, 0, 1), "sonar": (1, 1, 0)}


def test_calibration(spark):
    table = spark.createDataFrame([feature("one", "c1", ["semgrep"], 2, "a:1", 0, ["g"]), feature("one", "c2", ["semgrep", "snyk"], 2, "a:2", 0, []), feature("two", "c1", ["sonar"], 2, "a:3", 0, []), feature("three", "c1", ["snyk"], 2, "a:4", 0, ["g"])], FEATURE)
    gt = gt_of(spark, [("one", "g"), ("two", "h")])
    rows = calibration.labelled(table, gt)
    got = {r["tool"]: (r["tp"], r["fp"], r["p_smoothed"], r["weight"]) for r in calibration.global_weights(rows, CalibrationParams()).collect()}
    assert got == {"semgrep": (1, 1, 0.5, 0.0), "snyk": (0, 1, 0.333333, -0.693147), "sonar": (0, 1, 0.333333, -0.693147)}
    own = calibration.weights_by_owasp(rows, CalibrationParams()).where("tool = 'snyk'").first()
    assert (own["support_clusters"], own["support_cases"], own["gt_positive_clusters"], own["fallback_to_global"]) == (3, 2, 1, 1)
    assert [r["case_id"] for r in filters.suspicious_cases(table, gt).collect()] == ["two"]


def test_marginal(spark):
    table = spark.createDataFrame([feature("one", "c1", ["aikido"], 2, "a.py:1", 0, []), feature("one", "c2", ["snyk"], 2, "b.py:1", 0, ["g"])], FEATURE)
    config = AnalysisConfig(ks=(1, 2))
    rows = evaluation.read_features(table)
    cases = evaluation.cases(rows, gt_of(spark, [("one", "g")]))
    got = {(r["tool"], r["strategy"], r["k"]): r for r in evaluation.tool_marginal(rows, cases, evaluation.tool_utility(rows, cases), evaluation.rankings_without(rows, cases, None, config), config).collect()}
    noise, good = got["aikido", "baseline", 1], got["snyk", "baseline", 2]
    assert (noise["precision_full"], noise["precision_drop"], noise["neg_in_topk_full"], noise["neg_in_topk_drop"]) == (0.0, 1.0, 1, 0)
    assert (good["gt_coverage_full"], good["gt_coverage_drop"]) == (1.0, 0.0)


def test_compare_and_layout(spark):
    a = spark.createDataFrame([("x", "n", "t", "", None, 1.0), ("x", "m", "t", "", 3, 2.0)], "section string, name string, tool string, strategy string, k int, value double")
    got = {r["name"]: (r["a"], r["b"], r["delta"]) for r in compare.compared(a, a.where("k IS NULL").withColumn("value", F.lit(4.0))).collect()}
    assert got == {"n": (1.0, 4.0, 3.0), "m": (2.0, None, None)}
    assert compare.alerts({"effective_gt_tolerance": 0}, {"effective_gt_tolerance": 3}) == ["GT tolerance changed: 0 -> 3"]
    runs = spark.createDataFrame([("c", "t", "2024010101"), ("c", "t", "2024010201"), ("c", "t", "tmp")], "case_id string, tool string, run_id string")
    assert [r["run_id"] for r in layout.latest_runs(runs, ["case_id", "tool"]).collect()] == ["2024010201"]


def test_tool_and_macro_rows_of_each_tolerance(spark):
    raw = spark.createDataFrame([("s", "c", "g1", "x", "5", "5", None), ("s", "c", "g2", "y", "1", "1", None)], "suite_id string, case_id string, id string, file string, line string, end string, track string")
    found = items(spark, [("semgrep", "x", 6, 6, "LOW"), ("snyk", "y", 9, 9, "LOW")])
    suite = Suite(found, groundtruth.normalize_items(raw), AnalysisConfig(gt_tolerance_candidates=(0, 1, 10), ks=(2,)))
    tools = {(r["gt_tolerance"], r["tool"]): (r["tp"], r["fp"]) for r in suite.tolerance_tools.collect()}
    assert tools == {(t, tool): ((1, 0) if t >= least else (0, 1)) for t in (0, 1, 10) for tool, least in (("semgrep", 1), ("snyk", 10))}
    macro = {(r["gt_tolerance"], r["precision"], r["gt_coverage"]) for r in suite.tolerance_macro.collect()}
    assert macro == {(0, 0.0, 0.0), (1, 0.5, 0.5), (10, 1.0, 1.0)}
    row = {r["gt_tolerance"]: r for r in suite.tolerance_report.collect()}
    assert [row[t]["gt_overlap_1"] for t in (0, 1, 10)] == [0, 1, 2] and row[1]["macro_precision_baseline_k3"] is None and row[10]["gt_ambiguity_warnings_json"] == "[]"


def test_sweep_equals_an_analysis_at_each_tolerance(spark):
    """Models, rankings and metrics of one plan against a suite of its own for every tolerance, with items near several clusters."""
    rng = random.Random(7)
    cases = ["owasp2021-a01-case", "owasp2021-a02-case", "plain"]
    found = spark.createDataFrame(
        [("s", rng.choice(cases), rng.choice(["semgrep", "snyk", "sonar"]), f"F{k}", "r", "t", rng.choice(["HIGH", "LOW", None]), "VULNERABILITY", f"f{rng.randrange(6)}", rng.choice([None, rng.randrange(1, 90)]), None, None, k) for k in range(400)],
        "suite_id string, case_id string, tool string, finding_id string, rule_id string, title string, severity string, issue_type string, file_path string, line_number int, end_line_number int, cwe_id string, item_seq long",
    )
    gt = spark.createDataFrame(
        [("s", rng.choice(cases[1:]), f"g{rng.randrange(40)}" if k else "", f"f{rng.randrange(6)}", a, a + rng.randrange(5), "sast", "core") for k, a in enumerate(rng.randrange(1, 99) for _ in range(60))],
        "suite_id string, case_id string, gt_id string, file string, start_line int, end_line int, track string, set_name string",
    )
    config = AnalysisConfig(tolerance=1, gt_tolerance_candidates=(0, 2, 5), ks=(1, 3, 5, 10, 25))
    suite = Suite(found, gt, config)
    wide = {r["gt_tolerance"]: r for r in suite.tolerance_report.collect()}
    for t in config.gt_tolerance_candidates:
        one = Suite(found, gt, replace(config, gt_tolerance=t))
        for mine, other in ((suite.tolerance_tools, one.weights), (suite.tolerance_macro, one.macro)):
            assert sorted(map(str, mine.where(F.col("gt_tolerance") == t).select(*other.columns).collect())) == sorted(map(str, other.collect()))
        for r in one.macro.where("strategy IN ('baseline', 'calibrated')").collect():
            assert wide[t][f"macro_precision_{r['strategy']}_k{r['k']}"] == r["precision"]
        assert wide[t]["gt_overlap_1"] == one.features.where("gt_overlap = 1").count()


def test_candidates_of_a_text():
    assert tolerance.parse_candidates("3, 1;1 x -2\t0") == (3, 1, 0)
    assert tolerance.parse_candidates(None) == tolerance.parse_candidates(" ,") == (0, 1, 2, 3, 5, 10)


def test_declared_categories_count_first(spark):
    found = items(spark, [("semgrep", "x", 6, 6, "LOW")]).withColumn("case_id", F.explode(F.array(*map(F.lit, ("owasp2021-a01-case", "plain", "other")))))
    gt = spark.createDataFrame([], "suite_id string, case_id string, gt_id string, file string, start_line int, end_line int, track string, set_name string")
    declared = spark.createDataFrame([("s", "owasp2021-a01-case", "A09"), ("s", "plain", "A02")], "suite_id string, case_id string, owasp_id string")
    for one, wanted in ((Suite(found, gt, declared=declared), {"owasp2021-a01-case": "A09", "plain": "A02", "other": ""}), (Suite(found, gt), {"owasp2021-a01-case": "A01", "plain": "", "other": ""})):
        assert {r["case_id"]: r["owasp_id"] for r in one.features.collect()} == wanted
        assert {r["case_id"]: r["owasp_id"] or "" for r in one.swept.collect()} == wanted


def test_macro_from_topk(spark):
    rows = [("s", "a", "baseline", r, int(r <= 2), 4, r // 2) for r in range(1, 13)] + [("s", "b", "baseline", 1, 1, 0, None), ("s", "c", "baseline", 1, 0, 2, 0), ("s", "a", "agreement", 1, 0, 0, None)]
    found = evaluation.macro_from_topk(spark.createDataFrame(rows, "suite_id string, case_id string, strategy string, rank int, gt_overlap int, gt_total int, cumulative_gt_covered int"))
    got = {(r["strategy"], r["k"]): (r["precision"], r["gt_coverage"]) for r in found.collect()}
    assert got["baseline", 10] == ((0.2 + 1 + 0) / 3, (5 / 4 + 0) / 2) and got["baseline", 25] == ((2 / 12 + 1 + 0) / 3, (6 / 4 + 0) / 2)
    assert got["agreement", 50][0] == 0.0 and got["agreement", 50][1] != got["agreement", 50][1] and got["calibrated", 10][0] != got["calibrated", 10][0] and len(got) == 12
    assert evaluation.macro_from_topk(found.limit(0).selectExpr("suite_id", "'c' AS case_id", "strategy", "k AS rank", "1 AS gt_overlap", "1 AS gt_total", "1 AS cumulative_gt_covered")).count() == 0
