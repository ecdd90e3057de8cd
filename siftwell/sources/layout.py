"""Which runs of a results folder count, and the columns that paths carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Run folders are named by ten or sixteen digits.
RUN_ID = r"^[0-9]{10}([0-9]{6})?$"


def latest_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The largest run_id of each group among those that name a run; others are rejected."""
    return runs.where(F.col("run_id").rlike(RUN_ID)).groupBy(*keys).agg(F.max("run_id").alias("run_id"))


def only_latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each group's latest run."""
    return rows.join(latest_runs(rows.select(*keys, "run_id").distinct(), keys), [*keys, "run_id"], "left_semi")


def path_columns(path: Column) -> dict[str, Column]:
    """suite_id, case_id, tool and run_id from .../suites/S/cases/C/tool_runs/T/[repo/]R/file."""

    def part(pattern: str) -> Column:
        found = F.regexp_extract(path, pattern, 1)
        return F.when(found != "", found)

    return {
        "suite_id": part(r"/suites/([^/]+)/"),
        "case_id": part(r"/cases/([^/]+)/"),
        "tool": part(r"/tool_runs/([^/]+)/"),
        "run_id": part(r"/([^/]+)/[^/]+$"),
    }


def preferred_file(files: DataFrame, keys: list[str], repo_name: str | Column) -> DataFrame:
    """Of each run's files the first that exists: normalized.json, <repo>.normalized.json, its form with _ for -, any other; runs without one are left out."""
    name, repo = F.regexp_extract("path", r"([^/]+)$", 1), F.lit(repo_name)
    order = F.when(name == "normalized.json", 0).when(name == F.concat(repo, F.lit(".normalized.json")), 1).when(name == F.concat(F.replace(repo, F.lit("-"), F.lit("_")), F.lit(".normalized.json")), 2).when(name.endswith(".normalized.json"), 3)
    best = files.withColumn("_order", F.struct(order.alias("place"), "path")).where(order.isNotNull()).groupBy(*keys).agg(F.min("_order").alias("_best"))
    return files.join(best.select(*keys, F.col("_best.path").alias("path")), [*keys, "path"], "left_semi")
