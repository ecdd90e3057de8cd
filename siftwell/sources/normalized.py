"""Findings of scanners' reports as one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.config import AnalysisConfig
from siftwell.functions.paths import repo_relative
from siftwell.functions.severity import generic_severity, sarif_severity, semgrep_severity, sonar_severity
from siftwell.operators.resolution import CWE_NAMED, cwe_candidates, vendor_codes
from siftwell.sinks.shared import stored
from siftwell.sources import payload
from siftwell.sources.layout import only_latest, path_columns
from siftwell.sources.vendor_rules import with_vendor_rules

BLOCKS = ("owasp_top_10_2021", "owasp_top_10_2021_vendor")
FINDING = T.StructType([T.StructField(c, T.StringType()) for c in ("finding_id", "rule_id", "title", "severity", "file_path")] + [T.StructField(c, T.IntegerType()) for c in ("line_number", "end_line_number")]
                       + [T.StructField(c, T.StringType()) for c in ("issue_type", "vuln_class", "cwe_id")] + [T.StructField("cwe_ids", T.ArrayType(T.StringType()))] + [T.StructField(c, T.StructType([T.StructField("categories", T.ArrayType(T.StringType()))])) for c in BLOCKS])
RUN = T.StructType([T.StructField("schema_version", T.StringType()), T.StructField("tool", T.StringType()), T.StructField("tool_version", T.StringType()), T.StructField("findings", T.ArrayType(FINDING))])
COLUMNS = ["suite_id", "case_id", "tool", "run_id", "finding_id", "rule_id", "title", "severity", "issue_type", "file_path", "line_number", "end_line_number", "cwe_id", "cwe_ids", "owasp_tags", "vendor_codes", "item_seq"]


def _read(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One row per report, with the columns that its path carries."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("path")).withColumns(path_columns(F.col("path")))


def _texts(*lists: Column) -> Column:
    """The distinct texts of several lists, any of which may be null."""
    return F.array_distinct(F.array_compact(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])))


def _finished(rows: DataFrame, tool: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    named = rows if tool is None else rows.withColumn("tool", F.lit(tool))
    filled = named.withColumns({c: F.lit(None).cast("string") for c in ("issue_type", "cwe_id") if c not in named.columns})
    filled = filled.withColumns({c: F.lit(None).cast("array<string>") for c in ("cwe_ids", "owasp_tags", "vendor_codes") if c not in named.columns})
    return filled.withColumn("item_seq", _tool_order(F.col("tool")) * F.lit(1 << 40) + F.col("pos")).select(*COLUMNS, *keep)


def _tool_order(tool: Column) -> Column:
    """The tool's place among those of an analysis; others come after all of them."""
    known = AnalysisConfig().tools
    place = F.array_position(F.array(*map(F.lit, known)), F.lower(F.coalesce(tool, F.lit(""))))
    return F.when(place > 0, place - 1).otherwise(F.lit(len(known)).cast("bigint"))


def read_report_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Findings of normalised reports, with the path of each."""
    runs = _read(spark, paths, RUN).withColumn("tool", F.coalesce("tool", F.regexp_extract("path", r"/tool_runs/([^/]+)/", 1)))
    keep = ["suite_id", "case_id", "tool", "run_id", "path"]
    rows = runs.select(*keep, F.posexplode_outer("findings").alias("pos", "f")).select(*keep, "pos", "f.*").where("pos IS NOT NULL")
    return _finished(rows.withColumn("owasp_tags", _texts(*[F.col(f"{c}.categories") for c in BLOCKS], F.array("vuln_class"))), keep=("path",))


def read_runs(spark: SparkSession, path: str, latest: bool = True) -> DataFrame:
    """Findings of normalised reports (.../cases/C/tool_runs/T/R/normalized.json), of each tool's latest run."""
    found = read_report_files(spark, path).drop("path")
    return only_latest(found, ["suite_id", "case_id", "tool"]) if latest else found


SONAR = "issues array<struct<key:string,rule:string,severity:string,component:string,message:string,type:string,line:int,textRange:struct<startLine:int,endLine:int>>>"
# The keys that hold Aikido's issues, the first list counts; then those of objects that hold such a list.
AIKIDO_LISTS = ("data", "issues", "findings", "vulnerabilities", "blockingIssues", "blocking_issues", "openIssues", "open_issues", "newIssues", "new_issues")
AIKIDO_OBJECTS = ("result", "results", "scan", "scanResult", "scan_result")


IDS = ["path", "pos"]


def _at(place: str, kind: str = "string", payload: str = "r") -> Column:
    """What a payload has at a place; null if there is nothing, or something that is no such value."""
    return F.try_variant_get(payload, place, kind)


def _list_at(place: str, payload: str = "r") -> Column:
    """The scalars of a list at a place, or the one scalar there."""
    one = F.try_variant_get(payload, place, "string")
    return F.coalesce(F.try_variant_get(payload, place, "array<string>"), F.when(one != "", F.array(one)), F.array().cast("array<string>"))


def _filled(*values: Column) -> Column:
    """The first value that isn't blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values])


def _joined(rows: DataFrame, roles: DataFrame, names: list[str]) -> DataFrame:
    """rows with the lists of texts of their payloads, empty for none."""
    return rows.join(roles, IDS, "left").withColumns({n: F.coalesce(n, F.array().cast("array<string>")) for n in names})


def with_roles(rows: DataFrame, value: Column, tool: str) -> DataFrame:
    """rows (path, pos, ...) with the lists that payload.roles_of() names, from a payload of each row."""
    roles = payload.roles_of(tool)
    scalars = payload.leaves(rows, IDS, {"payload": value}, payload.WALKED)
    found = _joined(rows, payload.texts_by_role(scalars, IDS, roles, payload.TEXT_ROLES), list(roles))
    weak = F.when(F.size("weakness_fields") > 0, F.col("weakness_fields")).otherwise(F.col("weakness_field"))
    return found.withColumn("weakness_fields", weak).drop("weakness_field")


def read_semgrep(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """Results of Semgrep reports; CWE ids and tags come from wherever the rule's metadata has them.  A rule without a category is about security."""
    rows = _read(spark, path, T.StructType.fromDDL("results array<variant>")).select("suite_id", "case_id", "run_id", "path", F.posexplode("results").alias("pos", "r"))
    rows = with_roles(stored(rows), _at("$.extra.metadata", "variant"), "semgrep")
    meta = "$.extra.metadata"
    owasp = F.when(F.size(_list_at(f"{meta}.owasp")) > 0, _list_at(f"{meta}.owasp")).otherwise(_list_at(f"{meta}.owasp_top_10"))
    more = [_list_at(f"{meta}.{k}") for k in ("vulnerability_class", "category", "technology", "subcategory")]
    ids = cwe_candidates([F.col("cwe_fields"), F.col("weakness_fields")], [], F.col("cwe_texts"))
    line, rule, file = _at("$.start.line", "int"), _at("$.check_id"), _at("$.path")
    return _finished(rows.select(
        "suite_id", "case_id", "run_id", "pos", F.concat_ws(":", rule, file, line.cast("string")).alias("finding_id"), rule.alias("rule_id"), F.coalesce(_at("$.extra.message"), rule).alias("title"),
        semgrep_severity(_at("$.extra.severity")).alias("severity"), F.upper(F.coalesce(_filled(F.get(_list_at(f"{meta}.category"), F.lit(0))), F.lit("SECURITY"))).alias("issue_type"), repo_relative(file, root).alias("file_path"),
        line.alias("line_number"), F.coalesce(_at("$.end.line", "int"), line).alias("end_line_number"), F.get(ids, F.lit(0)).alias("cwe_id"), ids.alias("cwe_ids"), _texts(owasp, *more).alias("owasp_tags"),
    ), "semgrep")


# The keys of CWE ids in properties of SARIF, and the paths of a rule's texts.
SARIF_CWE_KEYS = ("cwe", "cwe_id", "cweId", "cwe_ids", "cweIds", "cwes")
SARIF_TEXTS = ("help/text", "fullDescription/text", "shortDescription/text", "name")
SARIF_ROLES = {
    "cwe_fields": [f"{root}/properties/{k}" for root in ("result", "rule") for k in SARIF_CWE_KEYS],
    "taxa": ["result/taxa/id", "result/taxa/name"],
    "tags": ["rule/properties/tags", "result/properties/tags", *[f"rule/{k}" for k in SARIF_TEXTS]],
}


def read_sarif(spark: SparkSession, path: str, tool: str = "snyk", vendor_rules: DataFrame | None = None) -> DataFrame:
    """Results of the first run of each SARIF report with their rule; of rules with one id the last counts.

    CWE ids come from the properties of both, from taxa and from tags and texts of the rule.  vendor_rules (see
    vendor_rules.rule_index) adds what a mapping file says of the rule: further ids, and OWASP codes of the vendor.
    """
    runs = _read(spark, path, T.StructType.fromDDL("runs array<struct<tool:struct<driver:struct<rules:array<variant>>>,results:array<variant>>>")).select("suite_id", "case_id", "run_id", "path", F.get("runs", F.lit(0)).alias("run"))
    results = runs.select("suite_id", "case_id", "run_id", "path", F.posexplode("run.results").alias("pos", "r")).withColumn("rule_id", _at("$.ruleId"))
    rules = runs.select("path", F.posexplode("run.tool.driver.rules").alias("_place", "rule")).withColumn("rule_id", _at("$.id", payload="rule")).where("rule_id IS NOT NULL")
    last = rules.groupBy("path", "rule_id").agg(F.max_by(F.struct("rule"), "_place").alias("_last")).select("path", "rule_id", "_last.rule")
    rows = stored(results.join(last, ["path", "rule_id"], "left"))
    scalars = payload.leaves(rows, IDS, {"result": F.col("r"), "rule": F.col("rule")}, ["properties", "taxa", "help", "fullDescription", "shortDescription", "name"])
    rows = _joined(rows, payload.texts_by_role(scalars, IDS, SARIF_ROLES, ("taxa",)), list(SARIF_ROLES))
    name = _filled(_at("$.name", payload="rule"), _at("$.shortDescription.text", payload="rule"))
    rows = rows.withColumn("rule_name", name)
    more = []
    if vendor_rules is not None:
        rows = with_vendor_rules(rows, vendor_rules)
        more = [F.col("rule_cwe_ids")]
    named = F.flatten(F.transform("tags", lambda t: F.slice(F.regexp_extract_all(t, F.lit(CWE_NAMED), 1), 1, 1)))
    ids = cwe_candidates([F.col("cwe_fields"), F.filter("taxa", lambda t: t.contains("CWE-")), named, *more], [])
    codes = vendor_codes([F.col("rule_owasp_codes")], []) if more else F.lit(None).cast("array<string>")
    place = "$.locations[0].physicalLocation"
    start = _at(f"{place}.region.startLine", "int")
    file = _at(f"{place}.artifactLocation.uri")
    title = F.coalesce(_at("$.shortDescription.text", payload="rule"), _at("$.name", payload="rule"), _at("$.message.text"), F.col("rule_id"))
    return _finished(rows.select(
        "suite_id", "case_id", "run_id", "pos", F.concat_ws(":", "rule_id", file, start.cast("string")).alias("finding_id"), "rule_id", title.alias("title"), sarif_severity(_at("$.level")).alias("severity"), file.alias("file_path"),
        start.alias("line_number"), F.coalesce(F.nullif(_at(f"{place}.region.endLine", "int"), F.lit(0)), start).alias("end_line_number"), F.get(ids, F.lit(0)).alias("cwe_id"), ids.alias("cwe_ids"),
        F.array_distinct("tags").alias("owasp_tags"), codes.alias("vendor_codes"),
    ), tool)


def read_sonar(spark: SparkSession, path: str) -> DataFrame:
    """Issues of saved Sonar exports; a component is project:path."""
    rows = _read(spark, path, T.StructType.fromDDL(SONAR)).select("suite_id", "case_id", "run_id", F.posexplode("issues").alias("pos", "r"))
    file = F.regexp_extract("r.component", "^[^:]*:(.*)$", 1)
    start = F.coalesce("r.textRange.startLine", "r.line")
    return _finished(rows.select(
        "suite_id", "case_id", "run_id", "pos", F.col("r.key").alias("finding_id"), F.col("r.rule").alias("rule_id"), F.coalesce("r.message", "r.rule").alias("title"), sonar_severity(F.col("r.severity")).alias("severity"),
        F.col("r.type").alias("issue_type"), F.when(file != "", file).otherwise(F.col("r.component")).alias("file_path"), start.alias("line_number"), F.coalesce("r.textRange.endLine", start).alias("end_line_number"),
    ), "sonar")


# The keys of a rule's standards by the way lists of them begin.
STANDARDS = {"cwe:": "CWE", "owaspTop10-2017:": "OWASP Top 10 2017", "owaspTop10-2021:": "OWASP Top 10 2021"}


def read_sonar_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule_key, name, tags, standards) of saved rules, for resolution.rule_classification(); standards may be a list or an object of lists."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)

    def listed(key: str) -> Column:
        return F.coalesce(F.from_json(F.get_json_object("value", f"$.rule.{key}"), "array<string>"), F.array().cast("array<string>"))

    named = [F.transform(listed(f"securityStandards['{key}']"), lambda x: F.concat(F.lit(start), x)) for start, key in STANDARDS.items()]
    whole = F.get_json_object("value", "$.rule.securityStandards")
    standards = F.when(F.ltrim(whole).startswith("["), F.from_json(whole, "array<string>")).otherwise(F.concat(*named))
    rules = rows.select(F.get_json_object("value", "$.rule.key").alias("rule_key"), F.get_json_object("value", "$.rule.name").alias("name"), listed("tags").alias("tags"), standards.alias("standards"))
    return rules.where("rule_key IS NOT NULL").dropDuplicates(["rule_key"])


# The keys of an issue's repository, in the order in which they count, and those of objects that have its id.
REPOSITORY_KEYS = ("code_repo_id", "codeRepoId", "repository_id", "repo_id")
REPOSITORY_OBJECTS = ("repository", "code_repo", "codeRepo", "codeRepository")


def of_repository(issue: str) -> Column:
    """The id of an issue's repository, as text."""
    return F.coalesce(*[_at(f"$.{k}", payload=issue) for k in REPOSITORY_KEYS], *[_at(f"$.{k}.id", payload=issue) for k in REPOSITORY_OBJECTS])


def read_aikido(spark: SparkSession, path: str, repo_id: str | None = None) -> DataFrame:
    """Issues of saved Aikido exports of one repository, if named: a list, or one under a key of AIKIDO_LISTS, in an object of AIKIDO_OBJECTS, or new and existing ones.

    CWE ids, tags and OWASP codes come from wherever an issue has them.
    """
    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path")).withColumns(path_columns(F.col("path")))

    def under(place: str) -> Column:
        """The list at a path; null where there is none.  Keys that hold something else don't spoil the others."""
        return F.from_json(F.get_json_object("value", place), "array<variant>")

    inner = [under(f"$.{outer}.{key}") for outer in AIKIDO_OBJECTS for key in AIKIDO_LISTS[:4]]
    wrapped = F.coalesce(*[under(f"$.{key}") for key in AIKIDO_LISTS], *inner, F.concat(under("$.new"), under("$.existing")))
    listed = F.from_json("value", "array<variant>")
    rows = texts.select("suite_id", "case_id", "run_id", "path", F.posexplode(F.when(F.ltrim("value").startswith("["), listed).otherwise(wrapped)).alias("pos", "r"))
    rows = rows if repo_id is None else rows.where(of_repository("r") == repo_id)
    rows = with_roles(stored(rows), F.col("r"), "aikido")
    start, rule = F.coalesce(_at("$.start_line", "int"), _at("$.line", "int")), _filled(*[_at(f"$.{k}") for k in ("rule_id", "rule", "type", "category")])
    title = _filled(*[_at(f"$.{k}") for k in ("title", "summary", "message", "name")])
    severity = F.coalesce(_filled(_at("$.severity_score")), _filled(_at("$.severity")), _filled(_at("$.risk")), _filled(_at("$.level")))
    ids = cwe_candidates([F.col("cwe_fields"), F.col("weakness_fields")], [], F.col("cwe_texts"))
    return _finished(rows.select(
        "suite_id", "case_id", "run_id", "pos", F.concat_ws(":", _at("$.id"), rule).alias("finding_id"), rule.alias("rule_id"), F.coalesce(title, rule).alias("title"), generic_severity(severity, "aikido").alias("severity"),
        F.coalesce(_at("$.affected_file"), _at("$.file_path")).alias("file_path"), start.alias("line_number"), F.coalesce(_at("$.end_line", "int"), start).alias("end_line_number"), F.get(ids, F.lit(0)).alias("cwe_id"),
        ids.alias("cwe_ids"), F.array_distinct("tags").alias("owasp_tags"), vendor_codes([F.col("owasp_fields")], [], F.col("owasp_texts")).alias("vendor_codes"),
    ), "aikido")
