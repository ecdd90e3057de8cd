"""Findings, ground truth and provenance derived from the benchmark tables.

The tables hold no scanner findings, so each view maps their rows to findings by a fixed rule.  The rules
are plain SQL that Spark and DuckDB read alike; {lineitem} and {part} stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CASE = "'owasp2021-a' || lpad(CAST(l_suppkey % 10 + 1 AS STRING), 2, '0') || '-case'"
_TOOL = "CASE l_linenumber % 4 WHEN 0 THEN 'semgrep' WHEN 1 THEN 'snyk' WHEN 2 THEN 'sonar' ELSE 'aikido' END"

FINDINGS = f"""
SELECT '{{suite}}' AS suite_id, {_CASE} AS case_id, {_TOOL} AS tool,
  'F' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS finding_id,
  'R' || CAST(l_partkey % 25 AS STRING) AS rule_id, 'Issue ' || CAST(l_partkey % 40 AS STRING) AS title,
  CASE WHEN l_quantity > 48 THEN NULL WHEN l_returnflag = 'R' THEN 'HIGH' WHEN l_returnflag = 'A' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  CASE l_linenumber % 4 WHEN 2 THEN CASE WHEN l_linestatus = 'F' THEN 'VULNERABILITY' ELSE 'CODE_SMELL' END
    WHEN 0 THEN CASE WHEN l_linestatus = 'F' THEN 'SECURITY' ELSE 'CORRECTNESS' END ELSE 'VULNERABILITY' END AS issue_type,
  CASE WHEN l_partkey % 20 = 0 THEN 'benchmark/f' ELSE 'src/f' END || CAST(l_partkey AS STRING) || '.py' AS file_path,
  CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(l_orderkey % 40 + 1 AS INT) END AS line_number,
  CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(l_orderkey % 40 + 1 + CAST(l_quantity AS INT) % 4 AS INT) END AS end_line_number,
  CASE l_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'CWE-79' WHEN 2 THEN 'cwe:89' WHEN 3 THEN '22' WHEN 4 THEN 'CWE-352'
    WHEN 5 THEN 'CWE 502' WHEN 6 THEN 'CWE-798' ELSE 'CWE-99999' END AS cwe_id,
  l_orderkey * 10 + l_linenumber AS item_seq
FROM {{lineitem}} WHERE {{kept}}
"""

GROUND_TRUTH = """
SELECT '{suite}' AS suite_id, 'owasp2021-a' || lpad(CAST(c AS STRING), 2, '0') || '-case' AS case_id,
  'OWASP2021_Acc_' || CAST(p_partkey AS STRING) AS gt_id, 'src/f' || CAST(p_partkey AS STRING) || '.py' AS file,
  CAST(p_size % 40 + 1 + CASE WHEN c = 10 THEN 1000 ELSE 0 END AS INT) AS start_line, CAST(p_size % 40 + 1 + p_size % 3 + CASE WHEN c = 10 THEN 1000 ELSE 0 END AS INT) AS end_line,
  CASE WHEN p_size % 7 = 0 THEN 'sca' ELSE 'sast' END AS track, CASE WHEN p_size % 2 = 0 THEN 'core' ELSE 'extended' END AS set_name
FROM {part}, (VALUES (1), (2), (3), (4), (5), (7), (8), (9), (10)) AS cases(c)
WHERE (p_partkey * 7 + c) % 5 = 0 AND p_partkey % 20 <> 0
"""

RAW_PATHS = f"""
SELECT {_CASE} AS case_id, {_TOOL} AS tool, l_orderkey, l_linenumber, l_partkey,
  CASE l_linenumber % 4 WHEN 0 THEN '/work/Repo/./src//f' || CAST(l_partkey AS STRING) || '.py'
    WHEN 1 THEN './src/f' || CAST(l_partkey AS STRING) || '.py'
    WHEN 2 THEN 'C:' || chr(92) || 'x' || chr(92) || 'repo' || chr(92) || 'src' || chr(92) || 'f' || CAST(l_partkey AS STRING) || '.py'
    ELSE '/tmp/repo/repo/src/f' || CAST(l_partkey AS STRING) || '.py' END AS raw_path
FROM {{lineitem}}
"""

TOOL_RUNS = f"""
SELECT DISTINCT {_CASE} AS case_id, {_TOOL} AS tool,
  CASE WHEN l_orderkey % 11 = 0 THEN 'tmp' ELSE {{day}} || '01' END AS run_id
FROM {{lineitem}}
"""

# The same findings with tags, vendor codes and a text, as lists joined by |.
TAGGED = f"""
SELECT *, CASE CAST(substr(title, 7) AS INT) % 6 WHEN 0 THEN 'owasp:A03|security' WHEN 1 THEN 'OWASP-A1:2017|x' WHEN 2 THEN 'owasp-2021-a5|OWASP A10' WHEN 3 THEN ''
    WHEN 4 THEN 'A7 2017|A07:2021' ELSE NULL END AS tags_text,
  CASE WHEN CAST(substr(title, 7) AS INT) % 2 = 0 THEN '' ELSE 'a4|A09|zz|A4' END AS vendor_text,
  CASE CAST(substr(title, 7) AS INT) % 5 WHEN 0 THEN 'See CWE-611 and cwe_22.' WHEN 1 THEN NULL ELSE 'Injection of CWE 79' END AS description
FROM ({FINDINGS}) tagged
"""

# The same findings with faults.
FLAWED = f"""
SELECT suite_id, case_id, tool, finding_id, CASE WHEN rule_id = 'R3' THEN NULL ELSE rule_id END AS rule_id, CASE WHEN title = 'Issue 0' THEN '' ELSE title END AS title,
  CASE WHEN title = 'Issue 5' THEN 'CRITICAL' ELSE severity END AS severity, file_path,
  CASE WHEN title = 'Issue 7' THEN 'x12' ELSE CAST(line_number AS STRING) END AS line_number, CAST(end_line_number AS STRING) AS end_line_number
FROM ({FINDINGS}) flawed
"""

RULES = """
SELECT 'R' || CAST(k AS STRING) AS rule_key, CASE WHEN k % 5 = 0 THEN NULL ELSE 'Rule ' || CAST(k AS STRING) END AS name,
  CASE WHEN k % 3 = 0 THEN 'cwe-' || CAST(20 + k AS STRING) || '|bug' ELSE 'bug' END AS tags_text,
  CASE k % 4 WHEN 0 THEN 'cwe:79|owaspTop10-2021:a3|cwe:23' WHEN 1 THEN 'owaspTop10:a1|cwe:89' WHEN 2 THEN '' ELSE 'owaspTop10-2017:a5|owaspTop10-2021:a1|cwe:unknown' END AS standards_text
FROM (SELECT DISTINCT p_partkey % 25 AS k FROM {part}) numbers WHERE k % 7 <> 6
"""

# A receipt of each tool run: its scanner's profile and the signature of its configuration.
RECEIPTS = f"""
SELECT DISTINCT '{{suite}}' AS suite_id, {_CASE} AS case_id, {_TOOL} AS tool,
  CASE WHEN l_suppkey % 10 = 3 THEN ' ' WHEN '{{suite}}' = 'suite_main' AND l_suppkey % 10 = 4 THEN 'strict' ELSE 'default' END AS profile,
  'h' || CAST(CASE WHEN l_linenumber % 4 = 1 THEN l_suppkey % 10 % 2 ELSE 0 END AS STRING) AS config_hash
FROM {{lineitem}} WHERE l_linenumber % 4 <> 3 AND {{kept}}
"""

# Payloads of five shapes, and texts that are none; n, m and c are numbers of the row.
PAYLOADS = """
SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN '{"title": " Flaw of CWE-' || n || '", "cwe": ["CWE-' || m || '", ' || n || '], "tags": ["owasp:A' || c || '", "x"]}'
    WHEN 1 THEN '{"weaknesses": [{"cweId": "CWE-' || n || '"}, {"name": "cwe_' || m || '"}], "message": {"text": "see A' || c || '"}}'
    WHEN 2 THEN '{"owasp": {"2021": ["A0' || c || '", {"code": "A2"}]}, "labels": ["L' || m || '"], "weakness": null}'
    WHEN 3 THEN '{"owaspTop10": {"codes": ["a' || c || '"]}, "rule": {"help": ["CWE ' || n || '", {"deep": [["CWE-' || m || '"]]}]}, "weakness": "CWE-5"}'
    WHEN 4 THEN '{"cwe": [], "title": ""}' ELSE '{"cwe": ["CWE-' || n || '"' END AS payload
FROM (SELECT o_orderkey, CAST(20 + o_orderkey % 70 AS STRING) AS n, CAST(21 + o_orderkey % 70 AS STRING) AS m, CAST(o_custkey % 9 + 1 AS STRING) AS c FROM {orders}) numbered
"""

# Mapping files of a vendor, one a rule, in three shapes.
VENDOR_FILES = """
SELECT k, CASE k % 4 WHEN 0 THEN '{"languages": {"py": {"Rule_' || k || ' name": {"owasp_top_10_2021": ["A0' || c || '"], "cwe": "CWE-' || k || '"}}}}'
    WHEN 1 THEN '{"R' || k || '": ["A0' || c || '", "A10"], "_meta": {"name": "none", "cwe": "CWE-1"}}'
    WHEN 2 THEN '{"R' || k || '": {"owasp_2021": "A0' || c || '", "cwe_ids": ["CWE-' || k || '", "CWE-99"], "name": "Rule ' || k || '"}}'
    ELSE '{"rules": [{"id": "R' || k || '", "owasp_2021": ["A0' || c || '"]}, {"name": "Rule  ' || k || '", "cweIds": ["CWE-7"]}, {"id": "R0"}]}' END AS value
FROM (SELECT DISTINCT CAST(p_partkey % 25 AS INT) AS k, CAST(p_partkey % 25 % 9 + 1 AS STRING) AS c FROM {part}) numbered
"""

# Findings of one tool with the id of their rule, which some lack, and its name.
NAMED_RULES = f"""
SELECT CASE WHEN l_quantity > 40 THEN NULL ELSE 'R' || CAST(l_partkey % 25 AS STRING) END AS rule_id,
  'RULE ' || CAST(l_partkey % 25 AS STRING) || CASE WHEN l_partkey % 25 % 4 = 0 THEN '  name' ELSE '' END AS rule_name
FROM {{lineitem}} WHERE {_TOOL} = 'snyk'
"""

# Documents of tool runs: some runs name their findings themselves, some lack metadata or findings.
RUN_DOCUMENTS = f"""
SELECT folder || '/' || CASE doc WHEN 0 THEN 'run.json' WHEN 1 THEN 'metadata.json' WHEN 2 THEN 'config_receipt.json' ELSE CASE WHEN r = 1 THEN 'own.json' ELSE 'normalized.json' END END AS path,
  CASE doc WHEN 0 THEN '{{"tool": "' || tool || '", "profile": "p' || r || '", "exit_code": ' || r || ', "started": "s' || r || '", "artifacts": {{' || CASE WHEN r = 1 THEN '"normalized": "own.json"' ELSE '' END || '}}}}'
    WHEN 1 THEN '{{"scanner_version": "1.' || r || '", "scan_time_seconds": "' || r || '.5", "config_hash": null}}'
    WHEN 2 THEN '{{"tool": " ' || tool || ' ", "schema_version": "2", "recorded_at": "now", "artifacts": {{"rules_inventory": {{"b": [1, ' || r || '], "a": "x"}}}}, "profile": "q"}}'
    ELSE '{{"findings": [' || repeat('{{"a": [1, 2]}}, ', r) || '{{}}]}}' END AS value
FROM (SELECT DISTINCT '/x/suites/suite_main/cases/' || {_CASE} || '/tool_runs/' || {_TOOL} || '/202401010' || CAST(l_orderkey % 3 AS STRING) AS folder, {_TOOL} AS tool, CAST(l_orderkey % 3 AS INT) AS r FROM {{lineitem}}) runs,
  (VALUES (0), (1), (2), (3)) AS docs(doc)
WHERE r < 2 OR doc IN (0, 2)
"""

# Ground-truth documents of cases, some of each kind broken or empty; the cases with the source that each asks for; markers of repositories.
CATALOGS = """
SELECT '/x/suites/suite_main/cases/case-' || CAST(k AS STRING) || '/gt/' || name AS path, value FROM (
  SELECT k, CASE WHEN doc = 0 THEN 'gt_markers.json' WHEN k % 8 = 3 THEN 'gt_catalog.yml' ELSE 'gt_catalog.yaml' END AS name,
    CASE WHEN doc = 0 THEN CASE k % 8 WHEN 0 THEN '[{"id": "a"}, 5, {"id": "b"}]' WHEN 1 THEN '{"items": []}' WHEN 7 THEN 'no json' END
      ELSE CASE k % 8 WHEN 0 THEN '- id: z' WHEN 1 THEN '- id: y1' || chr(10) || '- {id: y2}' WHEN 2 THEN 'items: [' WHEN 3 THEN 'items:' || chr(10) || '- id: y3' WHEN 5 THEN 'x: 1' WHEN 7 THEN '[{"id": "y7"}]' END END AS value
  FROM (SELECT DISTINCT p_partkey % 40 AS k FROM {part}) numbers, (VALUES (0), (1)) AS docs(doc)) written
WHERE value IS NOT NULL
"""
GT_CASES = """
SELECT 'suite_main' AS suite_id, 'case-' || CAST(k AS STRING) AS case_id, CASE k % 5 WHEN 0 THEN 'auto' WHEN 1 THEN ' Markers' WHEN 2 THEN 'YAML' WHEN 3 THEN 'off' ELSE 'odd' END AS gt_source, CAST(k % 8 AS INT) AS shape
FROM (SELECT DISTINCT p_partkey % 40 AS k FROM {part}) numbers
"""

# Manifests of cases, some under the earlier name and with runs under their earlier key.
MANIFESTS = """
SELECT '/x/suites/suite_main/cases/case-' || CAST(k AS STRING) || CASE WHEN k % 3 = 0 THEN '/run_manifest.json' ELSE '/case.json' END AS path,
  '{"case": {"id": "' || CASE WHEN k % 4 = 0 THEN '' ELSE 'id-' || CAST(k AS STRING) END || '"}, "timestamps": {"finished": "t' || CAST(k AS STRING) || '"}, "scanners_requested": ["b", "a"], "'
    || CASE WHEN k % 2 = 0 THEN 'tool_runs' ELSE 'scans' END || '": {"b": {"exit_code": ' || CAST(k % 2 AS STRING) || '}, "a": {"exit_code": 0}, "c": {}}' || CASE WHEN k % 5 = 0 THEN ', "analysis": {"x": 1}' ELSE '' END || '}' AS value
FROM (SELECT DISTINCT p_partkey % 200 AS k FROM {part}) numbers
"""

# Severities as tools write them.
SEVERITIES = ("critical", "crit", "Blocker", "major", "high", "error", "medium", "moderate", "warning", "warn", "minor", "low", "info", "informational", "note", "none", "very high risk", "", "severe", "7.5", "4", ".5", "0", "-3")

# A small dimension in place of a full CWE catalogue.
CWE_OWASP = {
    "CWE-79": ["A03"],
    "CWE-89": ["A03"],
    "CWE-22": ["A01"],
    "CWE-352": ["A01"],
    "CWE-502": ["A08"],
    "CWE-798": ["A07", "A02"],
}
CWE_OWASP_2017 = {"CWE-79": ["A7"], "CWE-89": ["A1"], "CWE-22": ["A5"], "CWE-611": ["A4", "A5"], "CWE-502": ["A8"]}
# The cases that a suite is planned to have.
CASES = tuple(f"owasp2021-a{n:02}-case" for n in range(1, 13))
SUITES = {"suite_main": "true", "suite_prev": "l_orderkey % 10 < 8"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def findings(spark: SparkSession, sf_dir: str, suite: str = "suite_main") -> DataFrame:
    text = FINDINGS.replace("{suite}", suite).replace("{kept}", SUITES[suite])
    return spark.sql(text, lineitem=_table(spark, sf_dir, "lineitem"))


def ground_truth(spark: SparkSession, sf_dir: str, suite: str = "suite_main") -> DataFrame:
    return spark.sql(GROUND_TRUTH.replace("{suite}", suite), part=_table(spark, sf_dir, "part"))


def raw_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_PATHS, lineitem=_table(spark, sf_dir, "lineitem"))


def tool_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TOOL_RUNS.replace("{day}", "date_format(l_shipdate, 'yyyyMMdd')"), lineitem=_table(spark, sf_dir, "lineitem"))


def cwe_owasp(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CWE_OWASP.items()), "cwe_id string, owasp_2021 array<string>")


def cwe_mapping(spark: SparkSession) -> DataFrame:
    """cwe_owasp() with both editions."""
    rows = [(c, CWE_OWASP_2017.get(c), CWE_OWASP.get(c)) for c in sorted({*CWE_OWASP, *CWE_OWASP_2017})]
    return spark.createDataFrame(rows, "cwe_id string, owasp_2017 array<string>, owasp_2021 array<string>")


def _split(name: str) -> Column:
    return F.filter(F.split(F.coalesce(name, F.lit("")), "[|]"), lambda x: x != "")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(TAGGED.replace("{suite}", "suite_main").replace("{kept}", "true"), lineitem=_table(spark, sf_dir, "lineitem"))
    return rows.withColumns({"owasp_tags": _split("tags_text"), "vendor_field": _split("vendor_text")})


def flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLAWED.replace("{suite}", "suite_main").replace("{kept}", "true"), lineitem=_table(spark, sf_dir, "lineitem"))


def _with_braces(text: str, table: str) -> str:
    """A text whose braces, but for those of the table's name, are no parameters."""
    return text.replace("{", "{{").replace("}", "}}").replace(f"{{{{{table}}}}}", f"{{{table}}}")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_with_braces(PAYLOADS, "orders"), orders=_table(spark, sf_dir, "orders"))


def vendor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_with_braces(VENDOR_FILES, "part"), part=_table(spark, sf_dir, "part")).select(F.lit(0).alias("priority"), "value")


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_with_braces(RUN_DOCUMENTS, "lineitem"), lineitem=_table(spark, sf_dir, "lineitem"))


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of made files, those of a file one after another."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.explode(F.sequence(F.lit(1), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("k"))
    content = F.concat(F.lit("line "), F.col("k").cast("string"), F.lit(" of "), F.col("o_custkey").cast("string"))
    return orders.select(F.concat(F.lit("src/o"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias("path"), F.floor((F.col("k") - 1) / 2).alias("block"), content.alias("content"))


def catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_with_braces(CATALOGS, "part"), part=_table(spark, sf_dir, "part"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_with_braces(MANIFESTS, "part"), part=_table(spark, sf_dir, "part"))


def gt_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GT_CASES, part=_table(spark, sf_dir, "part"))


def case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of case lists, a list a nation: every third with a header, the others by place."""
    customers = _table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    named = F.col("c_nationkey") % 3 == 0
    key = F.col("c_custkey").cast("string")
    path, blank = F.concat(F.lit("/repos/"), F.col("c_name")), F.lit("")
    by_name = F.array(F.when(F.col("c_custkey") % 2 == 0, path).otherwise(blank), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("key #"), key)).otherwise(blank), F.concat(F.lit(" t"), key))
    by_place = F.when(F.col("c_custkey") % 4 == 0, F.array(path)).when(F.col("c_custkey") % 4 == 1, F.array(F.concat(F.lit("# "), key), path)).otherwise(F.array(F.concat(F.lit("Case "), key), path, blank, F.lit("main")))
    rows = customers.select(F.col("c_nationkey").alias("list"), F.col("c_custkey").alias("place"), F.when(named, by_name).otherwise(by_place).alias("cells"))
    headers = customers.where(named).select(F.col("c_nationkey").alias("list"), F.lit(-1).alias("place"), F.array(*map(F.lit, ("Repo_Path", "repo_key", "track"))).alias("cells")).distinct()
    return rows.unionByName(headers)


def named_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(NAMED_RULES, lineitem=_table(spark, sf_dir, "lineitem"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RULES, part=_table(spark, sf_dir, "part"))
    return rows.select("rule_key", "name", _split("tags_text").alias("tags"), _split("standards_text").alias("standards"))


def receipts(spark: SparkSession, sf_dir: str, suite: str = "suite_main") -> DataFrame:
    return spark.sql(RECEIPTS.replace("{suite}", suite).replace("{kept}", SUITES[suite]), lineitem=_table(spark, sf_dir, "lineitem"))


def planned(spark: SparkSession, suite: str = "suite_main") -> DataFrame:
    return spark.createDataFrame([(suite, c) for c in CASES], "suite_id string, case_id string")


def reports(spark: SparkSession, sf_dir: str, suite: str = "suite_main") -> DataFrame:
    """(suite_id, case_id, tool) of the reports that exist: those with findings and two of a case without any."""
    empty = [(suite, CASES[10], t) for t in ("semgrep", "snyk")]
    return findings(spark, sf_dir, suite).select("suite_id", "case_id", "tool").distinct().unionByName(spark.createDataFrame(empty, "suite_id string, case_id string, tool string"))
