"""Tables that earlier analyses wrote as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files' rows as texts, with the columns in the order of their header; rows without any text are left out."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths)
    return rows.where(F.trim(F.concat_ws("", *[F.col(f"`{c}`") for c in rows.columns])) != "")


def read_feature_tables(spark: SparkSession, pattern: str) -> list[DataFrame]:
    """The feature tables (.../cases/C/...csv) that a pattern names, one frame for each header that occurs.

    A blank or missing case_id is taken from the path.  The driver learns the headers and the files' names only.
    """
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("place"))
    heads = lines.groupBy("path").agg(F.min_by("value", "place").alias("head"))
    files: dict[str, list[str]] = {}
    for row in heads.collect():
        files.setdefault(row["head"], []).append(row["path"])
    case = F.regexp_extract(F.col("_metadata.file_path"), r"/cases/([^/]+)/", 1)
    found = []
    for head in sorted(files):
        rows = read_csv(spark, sorted(files[head]))
        given = F.nullif(F.trim("case_id"), F.lit("")) if "case_id" in rows.columns else F.lit(None).cast("string")
        found.append(rows.withColumn("case_id", F.coalesce(given, case)))
    return found
