"""Tables that grow by what is new: findings of earlier layouts, and the index of a suite's cases.

What was taken stands in a manifest beside the table, so a second run over the same files takes nothing, and one over changed files
replaces the findings of their runs alone.  Tables are partitioned by what is replaced at once, and Spark replaces only partitions that
it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.groundtruth import CASE
from siftwell.sinks.shared import stored
from siftwell.sources.case_lists import safe_name
from siftwell.sources.layout import latest_runs, preferred_file
from siftwell.sources.normalized import read_report_files

TAKEN = [*CASE, "tool"]
_UPSERT = {"partitionOverwriteMode": "dynamic"}


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def legacy_files(spark: SparkSession, root: str) -> DataFrame:
    """(tool, repo, run_id, path, length, modified) of the JSON files of the earlier layout, root/TOOL/REPO/RUN/FILE; nothing is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
    names = [F.regexp_extract("path", r"/([^/]+)/([^/]+)/([^/]+)/[^/]+$", k).alias(c) for k, c in ((1, "tool"), (2, "repo"), (3, "run_id"))]
    return files.select(*names, "path", "length", F.col("modificationTime").alias("modified"))


def import_legacy(spark: SparkSession, root: str, table: str, suite_id: str, cases: DataFrame | None = None, run_id: str = "latest", tools: tuple[str, ...] | None = None) -> DataFrame:
    """Take the findings of the earlier layout below root into table/findings; what was done with each run: (suite_id, case_id, tool, repo, run_id, path, action).

    cases: (repo, case_id); without it a case is named by its repository.  Of each tool and repository the latest run counts, or the one named.
    action is imported, replaced, or unchanged for files that the manifest (table/taken) has with their length and time.
    Each import replaces the findings of its suite, case and tool.
    """
    files = legacy_files(spark, root)
    files = files if tools is None else files.where(F.col("tool").isin(*tools))
    named = files.join(latest_runs(files, ["tool", "repo"]), ["tool", "repo", "run_id"], "left_semi") if run_id == "latest" else files.where(F.col("run_id") == run_id)
    best = preferred_file(named, ["tool", "repo", "run_id"], F.col("repo"))
    known = best.withColumn("_case", F.lit(None).cast("string")) if cases is None else best.join(cases.select("repo", F.col("case_id").alias("_case")), "repo", "left")
    wanted = known.select(F.lit(suite_id).alias("suite_id"), safe_name(F.coalesce("_case", "repo")).alias("case_id"), "tool", "repo", "run_id", "path", "length", "modified")
    if _there(spark, f"{table}/taken"):
        before = spark.read.schema(wanted.schema).parquet(f"{table}/taken").select(*TAKEN, F.struct("path", "length", "modified").alias("_before"))
        told = wanted.join(before, TAKEN, "left").withColumn("action", F.when(F.col("_before").isNull(), "imported").when(F.col("_before") == F.struct("path", "length", "modified"), "unchanged").otherwise("replaced"))
    else:
        told = wanted.withColumn("action", F.lit("imported"))
    # the files to take are a list of Spark's own file index, so they come to the driver as those do
    done = [r.asDict() for r in told.select(*wanted.columns, "action").collect()]
    result = spark.createDataFrame([tuple(r.values()) for r in done], told.select(*wanted.columns, "action").schema)
    taken = result.where("action <> 'unchanged'")
    paths = [r["path"] for r in done if r["action"] != "unchanged"]
    if paths:
        place = taken.select("path", F.col("suite_id").alias("_suite"), F.col("case_id").alias("_case"), F.col("tool").alias("_tool"), F.col("run_id").alias("_run"))
        found = read_report_files(spark, paths).join(place, "path").withColumns({"suite_id": F.col("_suite"), "case_id": F.col("_case"), "tool": F.col("_tool"), "run_id": F.col("_run")})
        found.drop("path", "_suite", "_case", "_tool", "_run").write.mode("overwrite").options(**_UPSERT).partitionBy(*TAKEN).parquet(f"{table}/findings")
        taken.drop("action").write.mode("overwrite").options(**_UPSERT).partitionBy(*TAKEN).parquet(f"{table}/taken")
    return result.drop("length", "modified")


def upsert(rows: DataFrame, path: str, keys: list[str], ignored: tuple[str, ...] = ()) -> DataFrame:
    """Write those of rows that are new or differ from what the table at path has under their keys; they are returned.

    Other rows of the table stay as they are, and are not written again.  ignored: columns whose change alone is none, such as times.
    Keys are distinct in rows.
    """
    spark, compared = rows.sparkSession, [c for c in rows.columns if c not in (*keys, *ignored)]

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("row_digest", F.sha2(F.to_json(F.struct(*compared), {"ignoreNullFields": "false"}), 256))

    changed = rows
    if _there(spark, path):
        before = marked(spark.read.schema(rows.schema).parquet(path)).select(*keys, "row_digest")
        changed = marked(rows).join(before, [*keys, "row_digest"], "left_anti").drop("row_digest")
    changed = stored(changed)  # before the table changes
    if not changed.isEmpty():
        changed.write.mode("overwrite").options(**_UPSERT).partitionBy(*keys).parquet(path)
    return changed
