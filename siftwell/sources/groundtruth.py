"""Ground truth from marked source files, captured JSON and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts above this size and documentation hold no markers.
MOST_BYTES = 1_000_000
_SKIPPED = r"(?i)(^|/)(\.[^/]+|node_modules|__pycache__|venv|dist|build|target|docs)/|(^|/)README[^/]*$|\.(md|rst)$"
_FIELD = r"\b([A-Za-z_]+)=([^\s,;]+)"
_BLOCK = r"GT:([A-Za-z0-9_.-]+?)_(START|END)\b"


def _lines(spark: SparkSession, root: str, most_bytes: int) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    file = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + root.rstrip("/").replace("file://", "") + "/", "")
    kept = files.withColumn("file", file).where((F.col("size") <= most_bytes) & ~F.col("file").rlike(_SKIPPED) & F.col("value").contains("GT"))
    return kept.select("file", F.posexplode(F.split("value", "\r?\n")).alias("pos", "text")).where(F.col("text").contains("GT")).select("file", (F.col("pos") + 1).alias("line"), "text")


def read_markers(spark: SparkSession, root: str, token: str = "GT_MARKER", most_bytes: int = MOST_BYTES) -> DataFrame:
    """(gt_id, file, start_line, end_line, track, set_name) of the markers below root.

    A marker is a line with the token (any case) and key=value fields (id, track, set, ...), or a block from GT:<id>_START to
    GT:<id>_END, whose range is swapped if reversed.
    """
    lines = _lines(spark, root, most_bytes)
    marked = lines.where(F.lower("text").contains(token.lower())).withColumns({"keys": F.regexp_extract_all("text", F.lit(_FIELD), 1), "values": F.regexp_extract_all("text", F.lit(_FIELD), 2)})

    def value(name: str):
        """The first value given for a key."""
        return F.get("values", F.array_position(F.transform("keys", lambda k: F.lower(k)), name).cast("int") - 1)

    single = marked.select(value("id").alias("gt_id"), "file", F.col("line").alias("start_line"), F.col("line").alias("end_line"), value("track").alias("track"), value("set").alias("set_name"))
    ends = lines.select("file", "line", F.regexp_extract("text", _BLOCK, 1).alias("gt_id"), F.regexp_extract("text", _BLOCK, 2).alias("edge")).where("gt_id <> ''")
    both = ends.groupBy("file", "gt_id").agg(F.max(F.when(F.col("edge") == "START", F.col("line"))).alias("a"), F.max(F.when(F.col("edge") == "END", F.col("line"))).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    block = both.select("gt_id", "file", F.least("a", "b").alias("start_line"), F.greatest("a", "b").alias("end_line"), F.lit(None).cast("string").alias("track"), F.lit(None).cast("string").alias("set_name"))
    return single.where("gt_id IS NOT NULL").unionByName(block)


def first_source(candidates: list[tuple[str, DataFrame]]) -> tuple[str, DataFrame | None]:
    """The first source, by name, that has items; ("none", None) if none has."""
    for name, df in candidates:
        if not df.isEmpty():
            return name, df
    return "none", None
