"""Import of the earlier layout, and the index of a suite, run more than once."""

import os
import time

from pyspark.sql import functions as F

from siftwell.sinks import ingest
from siftwell.sources import layout, manifests
from tests.test_sources import put


def report(*ids):
    return {"tool": "x", "findings": [{"finding_id": i, "file_path": "a.py", "line_number": 1} for i in ids]}


def rows(spark, table):
    return sorted((r["case_id"], r["tool"], r["run_id"], r["finding_id"]) for r in spark.read.parquet(f"{table}/findings").collect())


def actions(df):
    return {(r["case_id"], r["tool"]): r["action"] for r in df.collect()}


def test_import_takes_what_is_new(spark, tmp_path):
    runs, table = tmp_path / "runs", f"{tmp_path}/silver"
    put(runs, "semgrep/my-repo/2024010101/normalized.json", report("old"))
    put(runs, "semgrep/my-repo/2024010201/normalized.json", report("a", "b"))
    put(runs, "semgrep/my-repo/2024010201/my-repo.normalized.json", report("wrong"))
    put(runs, "semgrep/my-repo/tmp/normalized.json", report("wrong"))
    put(runs, "snyk/my-repo/2024010101/my_repo.normalized.json", report("c"))
    put(runs, "snyk/my-repo/2024010101/z.normalized.json", report("wrong"))
    put(runs, "sonar/other/2024010101/raw.json", report("wrong"))
    first = ingest.import_legacy(spark, str(runs), table, "s")
    assert actions(first) == {("my-repo", "semgrep"): "imported", ("my-repo", "snyk"): "imported"}
    assert rows(spark, table) == [("my-repo", "semgrep", "2024010201", "a"), ("my-repo", "semgrep", "2024010201", "b"), ("my-repo", "snyk", "2024010101", "c")]
    written = {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "silver").rglob("*.parquet"))}
    assert set(actions(ingest.import_legacy(spark, str(runs), table, "s")).values()) == {"unchanged"}
    assert written == {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "silver").rglob("*.parquet"))}
    time.sleep(1.1)
    put(runs, "snyk/my-repo/2024010301/normalized.json", report("d"))
    put(runs, "aikido/other/2024010101/normalized.json", report("e"))
    again = ingest.import_legacy(spark, str(runs), table, "s")
    assert actions(again) == {("my-repo", "semgrep"): "unchanged", ("my-repo", "snyk"): "replaced", ("other", "aikido"): "imported"}
    assert rows(spark, table) == [("my-repo", "semgrep", "2024010201", "a"), ("my-repo", "semgrep", "2024010201", "b"), ("my-repo", "snyk", "2024010301", "d"), ("other", "aikido", "2024010101", "e")]
    cases = spark.createDataFrame([("other", "case one")], "repo string, case_id string")
    named = ingest.import_legacy(spark, str(runs), table, "t", cases, run_id="2024010101", tools=("aikido", "semgrep"))
    assert actions(named) == {("case_one", "aikido"): "imported", ("my-repo", "semgrep"): "imported"}
    assert {r["suite_id"] for r in spark.read.parquet(f"{table}/findings").select("suite_id").distinct().collect()} == {"s", "t"}


def test_nothing_to_take(spark, tmp_path):
    put(tmp_path, "runs/semgrep/r/odd/normalized.json", report("a"))
    assert ingest.import_legacy(spark, f"{tmp_path}/runs", f"{tmp_path}/t", "s").count() == 0


def test_preferred_files(spark):
    files = ["/r/1/x.normalized.json", "/r/1/my_repo.normalized.json", "/r/2/my-repo.normalized.json", "/r/2/my_repo.normalized.json", "/r/3/b.normalized.json", "/r/3/a.normalized.json", "/r/4/raw.json"]
    df = spark.createDataFrame([(f.split("/")[2], f) for f in files], "run string, path string")
    assert sorted(r["path"] for r in layout.preferred_file(df, ["run"], "my-repo").collect()) == ["/r/1/my_repo.normalized.json", "/r/2/my-repo.normalized.json", "/r/3/a.normalized.json"]


def test_suite_index_and_summary(spark, tmp_path):
    def manifest(case, name, value):
        put(tmp_path, f"suites/s/cases/{case}/{name}", value)

    manifest("one", "case.json", {"case": {"id": "own id"}, "repo": {"runs_repo_name": "r"}, "timestamps": {"finished": "t1"}, "scanners_requested": ["b", "a"], "tool_runs": {"b": {"exit_code": 0}, "a": {"exit_code": 2}, "c": None}, "analysis": {"x": 1}})
    manifest("one", "run_manifest.json", {"case": {"id": "wrong"}})
    manifest("two", "run_manifest.json", {"scans": {"z": {"exit_code": 0}}, "tool_runs": {}, "analysis": {}})
    manifest("bad", "case.json", "[1]")
    found = manifests.read_manifests(spark, str(tmp_path))
    queues = spark.createDataFrame([("s", "cases/two")], "suite_id string, case_dir string")
    summary = {r["case"]: tuple(r)[2:] for r in manifests.case_summary(found, queues).collect()}
    assert summary == {"own id": ("t1", "b,a", "b", "a", "yes", "cases/one", ""), "two": ("", "", "z", "", "no", "cases/two", "cases/two/analysis/triage_queue.csv")}
    index, path = manifests.index_rows(found), f"{tmp_path}/index"
    assert {r["case_id"] for r in ingest.upsert(index, path, ["suite_id", "case_id"]).collect()} == {"own id", "two"}
    assert ingest.upsert(index, path, ["suite_id", "case_id"]).count() == 0
    later = index.withColumn("finished", F.when(F.col("case_id") == "two", "t2").otherwise(F.col("finished")))
    assert ingest.upsert(later, path, ["suite_id", "case_id"], ignored=("finished",)).count() == 0
    changed = index.where("case_id = 'two'").withColumn("repo_name", F.lit("new"))
    assert [r["case_id"] for r in ingest.upsert(changed, path, ["suite_id", "case_id"]).collect()] == ["two"]
    assert {(r["case_id"], r["repo_name"], r["exit_codes"]) for r in spark.read.parquet(path).collect()} == {("own id", "r", '{"a":2,"b":0,"c":null}'), ("two", "new", '{"z":0}')}
