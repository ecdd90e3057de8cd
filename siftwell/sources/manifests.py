"""Case manifests of a suite: its index and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.groundtruth import CASE
from siftwell.sources.layout import path_columns

# The names of a case's manifest, the first that exists counts, and where it has its tool runs.
NAMES = ("case.json", "run_manifest.json")
RUNS = ("tool_runs", "scans")


def _text(place: str) -> Column:
    return F.nullif(F.try_variant_get("doc", place, "string"), F.lit(""))


def case_manifests(texts: DataFrame) -> DataFrame:
    """(suite_id, case_id, case_dir, repo_name, finished, scanners_requested, exit_codes, analysis) of manifests (path, value) at .../suites/S/cases/C/NAME.

    case_id is the one that the manifest names, else its folder; exit_codes has the code of each tool run, null where there is none; a
    manifest that is no JSON object is passed over.
    """
    columns, name = path_columns(F.col("path")), F.regexp_extract("path", "/cases/[^/]+/([^/]+)$", 1)
    rows = texts.withColumns({"name": name, "doc": F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value"))}).where(F.col("name").isin(*NAMES) & F.col("doc").isNotNull())
    placed = rows.select(columns["suite_id"].alias("suite_id"), columns["case_id"].alias("folder"), F.array_position(F.array(*map(F.lit, NAMES)), F.col("name")).alias("place"), "doc")
    best = placed.groupBy("suite_id", "folder").agg(F.min("place").alias("place"))
    runs = F.coalesce(*[F.when(F.size(m) > 0, m) for m in (F.try_variant_get("doc", f"$.{r}", "map<string, variant>") for r in RUNS)])
    codes = F.transform_values(runs, lambda k, v: F.try_variant_get(v, "$.exit_code", "int"))
    requested = F.coalesce(F.try_variant_get("doc", "$.scanners_requested", "array<string>"), F.array().cast("array<string>"))
    analysis = F.try_variant_get("doc", "$.analysis", "string")
    return placed.join(best, ["suite_id", "folder", "place"], "left_semi").select(
        "suite_id", F.coalesce(_text("$.case.id"), F.col("folder")).alias("case_id"), F.concat(F.lit("cases/"), "folder").alias("case_dir"), _text("$.repo.runs_repo_name").alias("repo_name"),
        _text("$.timestamps.finished").alias("finished"), requested.alias("scanners_requested"), F.coalesce(codes, F.create_map().cast("map<string,int>")).alias("exit_codes"),
        F.coalesce(~analysis.isin("", "{}", "[]", "false", "0"), F.lit(False)).alias("analysis"),
    )


def case_summary(manifests: DataFrame, queues: DataFrame | None = None) -> DataFrame:
    """One row per case under the summary's names; queues: (suite_id, case_dir) of the cases that have a review queue."""

    def tools(condition) -> Column:
        return F.array_join(F.array_sort(F.map_keys(F.map_filter("exit_codes", condition))), ",")

    rows = manifests if queues is None else manifests.join(queues.select("suite_id", "case_dir", F.lit(True).alias("_queue")).distinct(), ["suite_id", "case_dir"], "left")
    queue = F.lit("") if queues is None else F.when(F.col("_queue"), F.concat("case_dir", F.lit("/analysis/triage_queue.csv"))).otherwise("")
    return rows.select(
        "suite_id", F.col("case_id").alias("case"), F.coalesce("finished", F.lit("")).alias("finished"), F.array_join("scanners_requested", ",").alias("requested"),
        tools(lambda k, v: v == 0).alias("ok"), tools(lambda k, v: v != 0).alias("failed"), F.when(F.col("analysis"), "yes").otherwise("no").alias("analysis"), "case_dir", queue.alias("triage_queue"),
    )


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """case_manifests() of the suites below root."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{" + ",".join(NAMES) + "}").text(root, wholetext=True)
    return case_manifests(texts.select(F.col("_metadata.file_path").alias("path"), "value"))


def index_rows(manifests: DataFrame) -> DataFrame:
    """A suite's index: the places of each case, when it finished, and how its tools ended; write it with ingest.upsert(..., CASE)."""
    parts = {"case_json": "case.json", "tool_runs_dir": "tool_runs", "analysis_dir": "analysis", "gt_dir": "gt"}
    places = [F.concat("case_dir", F.lit(f"/{p}")).alias(n) for n, p in parts.items()]
    return manifests.select(*CASE, "repo_name", "case_dir", *places, "finished", "scanners_requested", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("exit_codes"))), {"ignoreNullFields": "false"}).alias("exit_codes"))
