"""Readers of scanners' reports and of ground truth, on small files."""

import json

from siftwell.operators import agreement
from siftwell.sources import groundtruth, normalized


def put(root, path, value):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(value if isinstance(value, str) else json.dumps(value))


def run(tool, run_id="2024010101", name="report.json"):
    return f"suites/s/cases/c/tool_runs/{tool}/{run_id}/{name}"


def test_normalized_runs(spark, tmp_path):
    one = {"tool": "semgrep", "findings": [{"finding_id": "a", "file_path": "x.py", "line_number": 3, "extra": 1}, {"finding_id": "b"}]}
    put(tmp_path, run("semgrep"), {**one, "findings": one["findings"][:1]})
    put(tmp_path, run("semgrep", "2024010201"), one)
    put(tmp_path, run("semgrep", "tmp"), one)
    got = normalized.read_runs(spark, str(tmp_path)).orderBy("item_seq").collect()
    assert [(r["suite_id"], r["case_id"], r["tool"], r["run_id"], r["finding_id"], r["line_number"]) for r in got] == [("s", "c", "semgrep", "2024010201", "a", 3), ("s", "c", "semgrep", "2024010201", "b", None)]


def test_reports(spark, tmp_path):
    put(tmp_path, "a/" + run("semgrep"), {"results": [{"check_id": "r1", "path": "/w/repo/x.py", "start": {"line": 2}, "end": {"line": 4}, "extra": {"message": "m", "severity": "ERROR", "metadata": {"category": "security", "cwe": ["CWE-79: XSS"]}}}]})
    rule = {"id": "r", "name": "old"}
    result = {"ruleId": "r", "level": "error", "message": {"text": "t"}, "locations": [{"physicalLocation": {"artifactLocation": {"uri": "x.py"}, "region": {"startLine": 5}}}]}
    put(tmp_path, "b/" + run("snyk"), {"runs": [{"tool": {"driver": {"rules": [rule, {**rule, "name": "new", "properties": {"cwe": ["CWE-89"]}}]}}, "results": [result, {"ruleId": "none"}]}]})
    put(tmp_path, "c/" + run("sonar"), {"issues": [{"key": "k", "rule": "r", "severity": "MAJOR", "component": "p:src/x.py", "type": "VULNERABILITY", "line": 7}]})
    issue = {"id": "1", "rule_id": "r", "severity": "critical", "affected_file": "x.py", "start_line": 1, "code_repo_id": "9"}
    put(tmp_path, "d/" + run("aikido"), {"issues": [issue, {**issue, "code_repo_id": "8"}]})
    put(tmp_path, "e/" + run("aikido"), [issue])

    def rows(df):
        return [(r["tool"], r["rule_id"], r["title"], r["severity"], r["file_path"], r["line_number"], r["end_line_number"], r["cwe_id"]) for r in df.orderBy("item_seq").collect()]

    assert rows(normalized.read_semgrep(spark, str(tmp_path / "a"), "/w/repo")) == [("semgrep", "r1", "m", "HIGH", "x.py", 2, 4, "CWE-79")]
    assert rows(normalized.read_sarif(spark, str(tmp_path / "b"))) == [("snyk", "r", "new", "HIGH", "x.py", 5, 5, "CWE-89"), ("snyk", "none", "none", None, None, None, None, None)]
    assert rows(normalized.read_sonar(spark, str(tmp_path / "c"))) == [("sonar", "r", "r", "HIGH", "src/x.py", 7, 7, None)]
    assert rows(normalized.read_aikido(spark, str(tmp_path / "d"), "9")) == rows(normalized.read_aikido(spark, str(tmp_path / "e"))) == [("aikido", "r", "r", "HIGH", "x.py", 1, 1, None)]


def test_aikido_shapes(spark, tmp_path):
    issue = {"id": "1", "rule": "r", "severity": "quite High", "file_path": "x.py"}
    shapes = [{"vulnerabilities": [issue]}, {"data": "no list", "scanResult": {"findings": [issue]}}, {"new": [issue], "existing": [{**issue, "id": "2"}]}, {"openIssues": [issue], "issues": []}]
    for k, shape in enumerate(shapes):
        put(tmp_path, f"{k}/" + run("aikido"), shape)
    counts = [normalized.read_aikido(spark, str(tmp_path / str(k))).count() for k in range(len(shapes))]
    assert counts == [1, 1, 2, 0] and normalized.read_aikido(spark, str(tmp_path / "0")).first()["severity"] == "HIGH"


def test_order_of_tools(spark, tmp_path):
    for tool in ("aikido", "other", "snyk"):
        put(tmp_path, run(tool, name="normalized.json"), {"tool": tool, "findings": [{"finding_id": "a"}, {"finding_id": "b"}]})
    got = normalized.read_runs(spark, str(tmp_path)).orderBy("item_seq").collect()
    assert [(r["tool"], r["finding_id"]) for r in got] == [(t, f) for t in ("snyk", "aikido", "other") for f in "ab"]


def test_markers(spark, tmp_path):
    put(tmp_path, "src/a.py", "x = 1\n# GT_MARKER id=g1 track=sast, set=core id=g9\n# GT:blk_END\ny\n# GT:blk_START\n")
    put(tmp_path, "README.md", "GT_MARKER id=no\n")
    put(tmp_path, ".hidden/a.py", "# GT_MARKER id=no\n")
    got = {(r["gt_id"], r["file"], r["start_line"], r["end_line"], r["track"], r["set_name"]) for r in groundtruth.read_markers(spark, str(tmp_path)).collect()}
    assert got == {("g1", "src/a.py", 2, 2, "sast", "core"), ("blk", "src/a.py", 3, 5, None, None)}
    empty = groundtruth.read_markers(spark, str(tmp_path), token="other").limit(0)
    assert groundtruth.first_source([("yaml", empty), ("markers", groundtruth.read_markers(spark, str(tmp_path)))])[0] == "markers"


def test_all_cwes_and_vendor_codes(spark, tmp_path):
    def semgrep(rule, **metadata):
        return {"check_id": rule, "path": "x.py", "start": {"line": 2}, "extra": {"message": "m", "severity": "ERROR", "metadata": metadata}}

    put(tmp_path, "a/" + run("semgrep"), {"results": [semgrep("r1", cwe=["CWE-79: XSS", "CWE-22: Path"], owasp=["A09:2021 - Logging"]), semgrep("r2", cwe=["CWE-9999"], owasp=["A09:2021 - Logging", "A3:2017 - Data"])]})
    rules = [{"id": "r", "properties": {"cwe": ["CWE-79", "CWE-22"]}}, {"id": "q", "properties": {"tags": ["security", "OWASP-A09"]}}, {"id": "p", "properties": {"tags": ["external/cwe/cwe-022"]}}]
    put(tmp_path, "b/" + run("snyk"), {"runs": [{"tool": {"driver": {"rules": rules}}, "results": [{"ruleId": k} for k in "rqp"]}]})
    put(tmp_path, "c/" + run("aikido", name="normalized.json"), {"tool": "aikido", "findings": [{"cwe_id": "CWE-79", "cwe_ids": ["79", "CWE-22"]}, {"owasp_top_10_2021_vendor": {"codes": ["A09"], "categories": ["A09:2021-Logging"]}}, {"cwe_ids": ["CWE-22"]}]})
    known = spark.createDataFrame([("CWE-79", ["A03"]), ("CWE-22", ["A01"])], "cwe_id string, owasp_2021 array<string>")

    def codes(df):
        return [r["codes"] for r in agreement.classified(df, known).orderBy("item_seq").collect()]

    assert codes(normalized.read_semgrep(spark, str(tmp_path / "a"))) == [["A03", "A01"], ["A09"]]
    assert codes(normalized.read_sarif(spark, str(tmp_path / "b"))) == [["A03", "A01"], ["A09"], ["A01"]]
    assert codes(normalized.read_runs(spark, str(tmp_path / "c"))) == [["A03", "A01"], ["A09"], ["A01"]]
