"""Payloads of any shape, mapping files of vendors, and the readers that use them."""

import json

from pyspark.sql import functions as F

from siftwell.operators import resolution
from siftwell.sources import normalized, payload, vendor_rules
from tests.test_sources import put, run


def walked(spark, values, keys=None):
    rows = spark.createDataFrame([(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in enumerate(values)], "n int, value string")
    return payload.leaves(rows, ["n"], {"p": F.try_parse_json("value")}, keys)


def scalars(value, path=(), places=()):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in scalars(v, (*path, k), places)]
    if isinstance(value, list):
        return [x for k, v in enumerate(value) for x in scalars(v, path, (*places, k))]
    return [] if value is None else [(list(path), list(places), json.dumps(value).strip('"'))]


def test_walk_finds_every_scalar(spark):
    deep = {"a": [{"b": {"c": [[1, "x"], [], {}]}}, None, True], "k.e'y\"": "odd", "d": {"e": {"f": {"g": {"h": ["end"]}}}}}
    values = [deep, [], {}, "not json {", None, json.dumps("text"), [["p", ["q"]]], {"a": 1.5, "b": None}]
    found = walked(spark, values).collect()
    got = sorted((r["n"], r["trail"], r["places"], r["text"]) for r in found)
    wanted = [(k, *x) for k, v in enumerate(values) for x in (scalars(v) if not isinstance(v, str) else ([([], [], "text")] if v == '"text"' else []))]
    assert got == sorted(wanted)
    assert {r["root"] for r in found} == {"p"}
    assert {(r["n"], r["text"]) for r in walked(spark, values, ["d", "b", "none"]).collect()} == {(0, "end")}
    assert walked(spark, []).count() == 0


def test_roles_of_a_payload(spark):
    issue = {
        "cwe": ["CWE-89", 22], "cweIds": "79", "cwe_id": {"id": "CWE-1"}, "weaknesses": [{"name": "CWE-5", "cweId": "CWE-4"}, "CWE-6", {"other": "CWE-7"}], "weakness": "CWE-8",
        "title": " see CWE_611 ", "message": {"text": "A10 and a03", "more": ["CWE 12"]}, "help": "CWE-13 A1", "rule": 404,
        "owasp": {"2021": ["A01", {"code": {"name": "a4"}}], "2017": ["A9"]}, "owaspTop10": {"codes": ["A2"], "year": "A7"}, "tags": ["t1", "", 5, "t1"], "type": "sast", "category": "c",
    }
    rows = spark.createDataFrame([("f", 0, json.dumps(issue)), ("f", 1, "{}"), ("g", 0, json.dumps({"weakness": ["CWE-9"], "title": ["A5"]})), ("h", 0, None)], "path string, pos int, value string").withColumn("r", F.try_parse_json("value"))
    found = {(r["path"], r["pos"]): r for r in normalized.with_roles(rows, F.col("r"), "aikido").collect()}
    assert len(found) == 4
    first = found["f", 0]
    assert first["cwe_fields"] == ["CWE-89", "22", "79"] and first["weakness_fields"] == ["CWE-4", "CWE-5", "CWE-6"]
    assert first["cwe_texts"] == ["see CWE_611", "A10 and a03", "CWE 12", "CWE-13 A1"]
    assert first["owasp_fields"] == ["A2", "A01", "a4"] and first["owasp_texts"] == ["see CWE_611", "A10 and a03", "CWE 12"]
    assert first["tags"] == ["t1", "t1", "c", "sast", "see CWE_611"]
    assert found["g", 0]["weakness_fields"] == ["CWE-9"] and found["f", 1]["tags"] == [] == found["h", 0]["cwe_fields"]
    ids = resolution.cwe_candidates([F.col("cwe_fields"), F.col("weakness_fields")], [], F.col("cwe_texts"))
    codes = resolution.vendor_codes([F.col("owasp_fields")], [], F.col("owasp_texts"))
    one = normalized.with_roles(rows.where("pos = 0 AND path = 'f'"), F.col("r"), "aikido").select(ids.alias("ids"), codes.alias("codes")).first()
    assert one["ids"] == ["CWE-89", "CWE-22", "CWE-79", "CWE-4", "CWE-5", "CWE-6", "CWE-611", "CWE-12", "CWE-13"]
    assert one["codes"] == ["A02", "A01", "A04", "A10", "A03"]


def test_readers_lose_no_classification(spark, tmp_path):
    issue = {"id": 7, "type": "sast", "severity": "high", "affected_file": "x.py", "start_line": 1, "weaknesses": [{"cweId": "CWE-502"}], "owasp": {"2021": ["A08"]}, "tags": ["deserialisation"], "description": "like CWE-79"}
    put(tmp_path, "a/" + run("aikido"), {"issues": [issue, {"title": "plain"}]})
    first, second = normalized.read_aikido(spark, str(tmp_path / "a")).orderBy("item_seq").collect()
    assert (first["cwe_ids"], first["vendor_codes"], first["rule_id"]) == (["CWE-502", "CWE-79"], ["A08"], "sast") and "deserialisation" in first["owasp_tags"]
    assert (second["cwe_ids"], second["vendor_codes"], second["title"]) == ([], [], "plain")
    meta = {"cwe": "CWE-89: SQL", "owasp": "A03:2021 - Injection", "technology": ["python"], "vulnerability_class": ["SQLi"], "category": ["best", "x"]}
    put(tmp_path, "b/" + run("semgrep"), {"results": [{"check_id": "r", "path": "x.py", "start": {"line": "odd"}, "extra": {"metadata": meta}}, {"check_id": "q", "extra": "text"}, {}]})
    one, two, three = normalized.read_semgrep(spark, str(tmp_path / "b")).orderBy("item_seq").collect()
    assert (one["cwe_ids"], one["owasp_tags"], one["issue_type"], one["line_number"]) == (["CWE-89"], ["A03:2021 - Injection", "SQLi", "best", "x", "python"], "BEST", None)
    assert (two["rule_id"], two["issue_type"], two["cwe_ids"]) == ("q", "SECURITY", []) and three["rule_id"] is None


def test_repository_of_an_issue(spark, tmp_path):
    names = [*normalized.REPOSITORY_KEYS, *normalized.REPOSITORY_OBJECTS]
    issues = [{"id": k, name: ({"id": 9} if k >= 4 else (9 if k % 2 else "9"))} for k, name in enumerate(names)]
    issues += [{"id": 90, "repo_id": "9", "code_repo_id": "8"}, {"id": 91, "repository": "9"}, {"id": 92}, {"id": 93, "code_repo_id": None, "codeRepo": {"id": "9"}}]
    put(tmp_path, run("aikido"), issues)
    kept = {r["finding_id"] for r in normalized.read_aikido(spark, str(tmp_path), "9").collect()}
    assert kept == {*map(str, range(8)), "93"}


def test_sarif_rules_taxa_and_vendor_rules(spark, tmp_path):
    rule = {"id": "py/Sqli", "name": "SqlInjection", "properties": {"tags": ["security", "CWE-20 and CWE-21"], "cwe": ["CWE-89"]}, "help": {"text": "about CWE-77"}}
    results = [{"ruleId": "py/Sqli", "taxa": [{"id": "CWE-5"}, {"name": "no"}], "properties": {"cweId": "CWE-6"}}, {"ruleId": "absent"}, {}]
    put(tmp_path, run("snyk"), {"runs": [{"tool": {"driver": {"rules": [{"id": "py/Sqli", "name": "old"}, rule]}}, "results": results}]})
    mapping = {"languages": {"py": {"Sql  Injection": {"owasp_2021": ["A09"]}, "sqlinjection": {"owasp_2021": "A03", "cweIds": ["CWE-564"]}}}}
    index = vendor_rules.rule_index(spark.createDataFrame([(0, json.dumps(mapping))], "priority int, value string"))
    found = normalized.read_sarif(spark, str(tmp_path), vendor_rules=index).orderBy("item_seq").collect()
    assert found[0]["cwe_ids"] == ["CWE-6", "CWE-89", "CWE-5", "CWE-20", "CWE-77", "CWE-564"] and found[0]["vendor_codes"] == ["A03"]
    assert [(r["rule_id"], r["cwe_ids"], r["vendor_codes"]) for r in found[1:]] == [("absent", [], []), (None, [], [])]
    assert normalized.read_sarif(spark, str(tmp_path)).where("vendor_codes IS NOT NULL").count() == 0


FILE = {
    "_meta": {"owasp_2021": ["A10"]},
    "languages": {"py": {"Hard_coded  Secret": {"owasp_top_10_2021": ["A07"], "owasp_2021": ["A01"], "cwe": "CWE-798"}, "Both": {"owasp_2021": ["A01"]}, " ": {"owasp_2021": ["A02"]}}, "js": "none"},
    "K1": ["A03", None, "A04"],
    "K2": {"owasp2021": "A05", "cweIds": ["CWE-1", None, 2], "name": "Second Rule"},
    "K3": {"name": "Nothing"},
    "Both": {"owasp_2021": ["A06"]},
    "rules": [{"id": " R1 ", "name": "First  RULE", "owasp_2021": ["A08"]}, {"rule_id": "R2", "cwe_ids": ["CWE-3"]}, {"id": "K1", "owasp_2021": ["A09"]}, {"id": "R3"}, "text", {"name": "Second rule", "owasp_2021": ["A01"]}],
}


def test_mapping_files_of_three_shapes(spark):
    files = spark.createDataFrame([(1, "not json"), (2, json.dumps(FILE)), (3, '{"K9": ["A01"]}'), (0, "[1]"), (0, "{}")], "priority int, value string")
    index = {r["rule_key"]: (r["owasp_codes"], r["cwe_ids"]) for r in vendor_rules.rule_index(files).collect()}
    assert index == {
        "Hard_coded  Secret": (["A07"], ["CWE-798"]), "hard coded secret": (["A07"], ["CWE-798"]), "both": (["A01"], []), "K1": (["A09"], []), "K2": (["A05"], ["CWE-1", "2"]), "Both": (["A06"], []),
        "R1": (["A08"], []), "First  RULE": (["A08"], []), "first rule": (["A08"], []), "R2": ([], ["CWE-3"]), "Second rule": (["A01"], []), "second rule": (["A01"], []),
    }


def test_findings_take_the_best_key(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps(FILE))
    index = vendor_rules.read_vendor_rules(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    pairs = [("K1", "Both"), ("none", "Both"), ("none", "BOTH"), (None, "hard-coded"), (None, "HARD coded_secret"), ("none", None), (None, None), ("", "First  RULE"), ("K1", None)]
    findings = spark.createDataFrame([(k, *pair) for k, pair in enumerate([*pairs, pairs[0]])], "n int, rule_id string, rule_name string")
    found = vendor_rules.with_vendor_rules(findings, index)
    assert [r["rule_owasp_codes"] for r in found.orderBy("n").collect()] == [["A09"], ["A06"], ["A01"], [], ["A07"], [], [], ["A08"], ["A09"], ["A09"]]
    assert vendor_rules.with_vendor_rules(findings, vendor_rules.read_vendor_rules(spark, [])).where("size(rule_owasp_codes) > 0").count() == 0
