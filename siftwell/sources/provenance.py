"""Where findings come from: tool runs, with what their folders say of the scanner, its configuration and its findings.

A run's folder holds run.json, which names further documents beside it: the scanner's metadata, a receipt of its configuration
and the normalised findings.  Every document is read once and brought down to the few values that some kind of document may give;
a run then takes each value from the document that it names for it, by one join on the document's path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.sources.layout import path_columns

# The names of documents that a run doesn't name itself.
NAMES = {"metadata": "metadata.json", "config_receipt": "config_receipt.json", "normalized": "normalized.json"}


def canonical(value: Column) -> Column:
    """A VARIANT as JSON without blanks and with sorted keys; null is the JSON null."""
    return F.coalesce(F.to_json(value), F.lit("null"))


def _text(place: str) -> Column:
    """What is at a place as text; empty for nothing, null, false, zero and empty values."""
    found = F.try_variant_get("doc", place, "string")
    return F.when(found.isNull() | found.isin("false", "0", "0.0", "[]", "{}"), "").otherwise(found)


def _number(place: str, kind: str) -> Column:
    """A number, or a text or truth value that stands for one; 0 for anything else."""
    found = F.trim(F.try_variant_get("doc", place, "string"))
    plain = F.when(found == "true", "1").when(found == "false", "0").otherwise(found).try_cast("double")
    return F.coalesce(plain.try_cast(kind), F.lit(0).cast(kind))


def config_signature() -> Column:
    """The hash of what a receipt (doc) says of the configuration: its tool, profile, version of the schema and inventory of rules."""
    inventory = F.when(F.schema_of_variant(F.try_variant_get("doc", "$.artifacts", "variant")).startswith("OBJECT"), F.try_variant_get("doc", "$.artifacts.rules_inventory", "variant"))
    quoted = [F.get(F.regexp_extract_all(F.to_json(F.struct(F.trim(_text(f"$.{c}")).alias("x"))), F.lit(r'(?s)^\{"x":(.*)\}$'), 1), F.lit(0)) for c in ("profile", "tool")]
    version = _number("$.schema_version", "bigint").cast("string")
    return F.sha2(F.concat(F.lit('{"artifacts":{"rules_inventory":'), canonical(inventory), F.lit('},"profile":'), quoted[0], F.lit(',"schema_version":'), version, F.lit(',"tool":'), quoted[1], F.lit("}")), 256)


def _documents(texts: DataFrame) -> DataFrame:
    """What each document (path, value) that is a JSON object may give to a run; value goes."""
    count = F.json_array_length(F.get_json_object("value", "$.findings"))
    docs = texts.select("path", F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value")).alias("doc"), count.alias("normalized_findings")).where("doc IS NOT NULL")
    return docs.select(
        "path", _text("$.scanner_version").alias("scanner_version"), _text("$.config_hash").alias("config_hash"), _number("$.scan_time_seconds", "double").alias("scan_time_seconds"),
        config_signature().alias("config_receipt_hash"), "normalized_findings",
    )


def tool_runs(texts: DataFrame) -> DataFrame:
    """One row per run of texts (path, value), the documents below .../suites/S/cases/C/tool_runs/T/.../R/.

    suite_id and case_id are those of the path; tool, run_id, profile, exit_code, started and finished those of run.json, without
    which a folder is no run; the rest is empty, 0 or null where the document that gives it is missing.  run_dir begins at cases.
    """
    is_run = texts.where(F.col("path").rlike(r"/cases/[^/]+/tool_runs/(.*/)?run\.json$") & F.ltrim("value").startswith("{")).withColumn("doc", F.try_parse_json("value")).where("doc IS NOT NULL")
    columns, folder = path_columns(F.col("path")), F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    runs = is_run.select(
        columns["suite_id"].alias("suite_id"), columns["case_id"].alias("case_id"), _text("$.tool").alias("tool"), F.coalesce(F.nullif(_text("$.run_id"), F.lit("")), F.regexp_extract(folder, "([^/]+)$", 1)).alias("run_id"),
        _text("$.profile").alias("profile"), _number("$.exit_code", "bigint").alias("exit_code"), _text("$.started").alias("started"), _text("$.finished").alias("finished"), folder.alias("folder"),
        F.array(*[F.struct(F.lit(kind).alias("kind"), F.coalesce(F.nullif(_text(f"$.artifacts.{kind}"), F.lit("")), F.lit(name)).alias("name")) for kind, name in NAMES.items()]).alias("named"),
    )
    wanted = runs.select("folder", F.explode("named").alias("_")).select("folder", "_.kind", F.concat("folder", F.lit("/"), "_.name").alias("path"))
    given = {"metadata": ("scanner_version", "config_hash", "scan_time_seconds"), "config_receipt": ("config_receipt_hash",), "normalized": ("normalized_findings",)}
    values = [F.max(F.when(F.col("kind") == kind, F.col(c))).alias(c) for kind, names in given.items() for c in names]
    found = wanted.join(_documents(texts), "path").groupBy("folder").agg(*values)
    rows = runs.drop("named").join(found, "folder", "left").na.fill("", ["scanner_version", "config_hash", "config_receipt_hash"]).na.fill(0.0, ["scan_time_seconds"])
    return rows.select(
        "suite_id", "case_id", "tool", "run_id", "profile", "scanner_version", "config_hash", "config_receipt_hash", "exit_code", "started", "finished", "scan_time_seconds", "normalized_findings",
        F.regexp_extract("folder", "/(cases/.*)$", 1).alias("run_dir"),
    )


def receipts(texts: DataFrame) -> DataFrame:
    """(suite_id, case_id, tool, run_dir, profile, config_hash) of the receipts among texts (path, value), for diagnostics.scanner_config(); config_hash is the signature."""
    rows = texts.where(F.col("path").rlike(r"/cases/[^/]+/tool_runs/[^/]+/(.*/)?config_receipt\.json$") & F.ltrim("value").startswith("{")).withColumn("doc", F.try_parse_json("value")).where("doc IS NOT NULL")
    columns = path_columns(F.col("path"))
    return rows.select(columns["suite_id"].alias("suite_id"), columns["case_id"].alias("case_id"), F.trim(_text("$.tool")).alias("tool"), F.regexp_extract("path", "/(cases/.*)/[^/]*$", 1).alias("run_dir"), F.trim(_text("$.profile")).alias("profile"), config_signature().alias("config_hash")).distinct()


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of the JSON documents below root."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), "value").where(F.col("path").contains("/tool_runs/"))


def read_tool_runs(spark: SparkSession, root: str) -> DataFrame:
    """tool_runs() of the suites below root."""
    return tool_runs(read_documents(spark, root))
