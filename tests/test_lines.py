"""Line numbers across blocks, paths that lead out of a repository, declared categories, and tool runs of several documents."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftwell.operators import diagnostics
from siftwell.sources import lines, provenance
from tests.test_sources import put


@pytest.mark.parametrize("size", ["37b", "128m"])
def test_numbers_across_blocks(spark, tmp_path, size):
    """Blocks of 37 bytes cut lines anywhere; one large file, files without an end of line, empty ones and odd names."""
    files = {"a.py": [f"line {k} " + "x" * (k % 50) for k in range(300)], "sub/b c+d%.py": ["one", "", "three"], "empty.py": [], "one": ["no end"], "crlf.py": ["p", "q"]}
    for name, rows in files.items():
        text = ("\r\n" if name == "crlf.py" else "\n").join(rows)
        put(tmp_path, name, text + ("\n" if rows and name != "one" else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        found = lines.read_lines(spark, str(tmp_path))
        if size == "37b":
            assert found.select("path").distinct().count() == 4
        got = sorted((r["path"].rpartition("/")[2], r["line"], r["content"]) for r in found.collect())
        wanted = sorted((name.rpartition("/")[2].replace(" ", "%20").replace("d%", "d%25"), k, x) for name, rows in files.items() for k, x in enumerate(rows, 1))
        assert got == wanted
        findings = spark.createDataFrame(
            [(0, "a.py", 300), (1, "./sub/../a.py", 1), (2, "../a.py", 1), (3, "/etc/passwd", 1), (4, f"{tmp_path}/one", 1), (5, "sub/b c+d%.py", 3), (6, "a.py", 301), (7, "a.py", 0), (8, None, 1), (9, "a.py", None), (10, "sub/x/../../crlf.py", 2), (11, "sub", 1), (12, "a.py", 300)],
            "n int, file_path string, line_number int",
        )
        got = {r["n"]: r["line_content"] for r in lines.with_line_content(findings, str(tmp_path), root=str(tmp_path)).collect()}
        assert got == {0: files["a.py"][299], 1: files["a.py"][0], 2: None, 3: None, 4: "no end", 5: "three", 6: None, 7: None, 8: None, 9: None, 10: "q", 11: None, 12: files["a.py"][299]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_paths_within(spark):
    paths = {"a/b": "a/b", "a//./b/": "a/b", "..": None, "a/..": None, "a/../../b": None, "a/../b": "b", "/r/x/a": "a", "/r/xy/a": None, "/r/x/../a": None, "": None, None: None}
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r["p"]: r["q"] for r in rows.select("p", lines.within(F.col("p"), "/r/x/").alias("q")).collect()} == paths


def test_declared_categories(spark, tmp_path):
    def gt(case, name, text):
        put(tmp_path, f"suites/s/cases/{case}/gt/{name}", text)

    gt("one", "gt_catalog.yaml", "# owasp: A01\nitems:\n  Owasp: 'a3'\nowasp: A04\n")
    gt("one", "suite_sets.yaml", "owasp: A09\n")
    gt("two", "gt_catalog.yaml", "owasp: none\nowasp: A05\n")
    gt("two", "gt_catalog.yml", "x: 1\n" * 50 + "owasp: A06\n")
    gt("two", "suite_sets.yml", '\n  owasp:  "A10"  \n')
    gt("three", "gt_catalog.yaml", "owasp: A11\n")
    gt("four", "other.yaml", "owasp: A02\n")
    found = lines.declared_owasp(lines.read_lines(spark, str(tmp_path), "*.y*ml"))
    assert sorted(tuple(r) for r in found.collect()) == [("s", "one", "A03"), ("s", "two", "A10")]


def signature(schema_version, tool, profile, inventory):
    stable = {"schema_version": schema_version, "tool": tool, "profile": profile, "artifacts": {"rules_inventory": inventory}}
    return hashlib.sha256(json.dumps(stable, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def test_tool_runs(spark, tmp_path):
    base = "suites/s/cases/c/tool_runs/semgrep"
    inventory = {"z": [1, {"b": None, "a": "é \"q\""}], "a": True}
    put(tmp_path, f"{base}/2024010101/run.json", {"tool": "semgrep", "run_id": "own", "profile": "p", "exit_code": "3.0", "started": 5, "artifacts": {"metadata": "sub/meta.json", "normalized": ""}})
    put(tmp_path, f"{base}/2024010101/sub/meta.json", {"scanner_version": "1.2", "scan_time_seconds": "2.5", "config_hash": "h"})
    put(tmp_path, f"{base}/2024010101/metadata.json", {"scanner_version": "wrong"})
    put(tmp_path, f"{base}/2024010101/config_receipt.json", {"schema_version": 1, "tool": " semgrep ", "profile": 'é"\\', "exit_code": 1, "artifacts": {"rules_inventory": inventory}})
    put(tmp_path, f"{base}/2024010101/normalized.json", {"findings": [{"a": [1, 2]}, {}, 3]})
    put(tmp_path, f"{base}/repo/2024010201/run.json", {"artifacts": "none", "exit_code": "x"})
    put(tmp_path, f"{base}/repo/2024010201/normalized.json", {"findings": "none"})
    put(tmp_path, f"{base}/repo/2024010201/config_receipt.json", {"artifacts": []})
    put(tmp_path, f"{base}/2024010301/run.json", "[1]")
    put(tmp_path, f"{base}/2024010401/normalized.json", {"findings": []})
    put(tmp_path, f"{base}/2024010501/run.json", "not json")
    one, two = provenance.read_tool_runs(spark, str(tmp_path)).orderBy("run_dir").collect()
    assert (one["suite_id"], one["case_id"], one["tool"], one["run_id"], one["profile"], one["exit_code"], one["started"], one["finished"]) == ("s", "c", "semgrep", "own", "p", 3, "5", "")
    assert (one["scanner_version"], one["config_hash"], one["scan_time_seconds"], one["normalized_findings"], one["run_dir"]) == ("1.2", "h", 2.5, 3, "cases/c/tool_runs/semgrep/2024010101")
    assert one["config_receipt_hash"] == signature(1, "semgrep", 'é"\\', inventory)
    assert (two["tool"], two["run_id"], two["exit_code"], two["scanner_version"], two["scan_time_seconds"], two["normalized_findings"]) == ("", "2024010201", 0, "", 0.0, None)
    assert two["config_receipt_hash"] == signature(0, "", "", None)
    found = provenance.receipts(provenance.read_documents(spark, str(tmp_path)))
    assert sorted((r["tool"], r["profile"], r["run_dir"]) for r in found.collect()) == [("", "", "cases/c/tool_runs/semgrep/repo/2024010201"), ("semgrep", 'é"\\', "cases/c/tool_runs/semgrep/2024010101")]
    assert diagnostics.scanner_config(found, ("semgrep", "snyk")).first()["missing_tools"] == ["snyk"]
