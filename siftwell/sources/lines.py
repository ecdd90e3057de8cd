"""Lines of text files with their numbers, and findings beside the line that they point at.

Spark splits large files, so a line's number is the number of lines in the blocks of its file before its own, and its place in
that.  A block is read in order by one task, which numbers its lines as they pass; a small table of the lines of every block
gives the rest.  No file is read by one task as a whole, and no line moves before its number is known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.functions.classification import owasp_id
from siftwell.sources.layout import path_columns


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's place among the rows of its file and block, which come one after another."""
    now, count = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path, block = batch.column("path"), batch.column("block").to_numpy(zero_copy_only=False)
        code = path.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.concatenate([[True], (code[1:] != code[:-1]) | (block[1:] != block[:-1])])
        first = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
        places = np.arange(1, n + 1) - first
        if (path[0].as_py(), block[0]) == now:
            places[first == 0] += count
        now, count = (path[n - 1].as_py(), block[n - 1]), int(places[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=["path", "block", "content", "place"])


def numbered_lines(texts: DataFrame) -> DataFrame:
    """(path, line, content), line from 1 on, of texts (path, block, content): the rows of a block in their order within one partition, blocks by their number."""
    placed = texts.select("path", "block", "content").mapInArrow(_numbered, "path string, block long, content string, place long")
    blocks = texts.groupBy("path", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(starts, ["path", "block"]).select("path", (F.col("before") + F.col("place")).alias("line"), "content")


def read_lines(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, line, content) of all text files below root, or of those whose name fits glob."""
    rows = spark.read.option("recursiveFileLookup", True)
    rows = (rows if glob is None else rows.option("pathGlobFilter", glob)).text(root)
    return numbered_lines(rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("content")))


def within(path: Column, root: str = "") -> Column:
    """A path relative to the repository, without . and .. and empty steps; null if it leads elsewhere.

    An absolute path counts only under root.  Links of the file system are not followed.
    """
    inside = F.when(~path.startswith("/"), path)
    if root:
        base = root.rstrip("/") + "/"
        inside = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(inside)
    steps = F.filter(F.split(inside, "/"), lambda x: ~x.isin("", "."))

    def step(so_far: Column, x: Column) -> Column:
        up = F.when(F.size(so_far) > 0, F.slice(so_far, F.lit(1), F.greatest(F.size(so_far) - 1, F.lit(0))))
        return F.when(x == "..", up).otherwise(F.array_append(so_far, x))

    return F.nullif(F.array_join(F.aggregate(steps, F.array().cast("array<string>"), step), "/"), F.lit(""))


def with_line_content(findings: DataFrame, repository: str, file_col: str = "file_path", line_col: str = "line_number", root: str = "", name: str = "line_content") -> DataFrame:
    """findings with the text of the line that each points at, in the files of a repository; null if there is none, or the path leads out of it.

    root: where the repository was when tools wrote absolute paths.
    """
    below = repository.rstrip("/").replace("file://", "") + "/"
    file = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    lines = read_lines(findings.sparkSession, repository).select(F.substring_index(file, below, -1).alias("_file"), F.col("line").alias("_line"), F.col("content").alias(name))
    keyed = findings.drop(name).withColumns({"_file": within(F.col(file_col), root), "_line": F.when(F.col(line_col) > 0, F.col(line_col).cast("bigint"))})
    named = keyed.where("_line IS NOT NULL").select("_file", "_line").distinct()
    return keyed.join(lines.join(named, ["_file", "_line"], "left_semi"), ["_file", "_line"], "left").drop("_file", "_line")


# The files that may declare a case's OWASP code, the first that does counts, and the lines in which they may.
DECLARING = ("gt_catalog.yaml", "gt_catalog.yml", "suite_sets.yaml", "suite_sets.yml")
DECLARING_LINES = 50


def declared_owasp(lines: DataFrame) -> DataFrame:
    """(suite_id, case_id, owasp_id) of the cases whose ground-truth files (.../suites/S/cases/C/gt/FILE) declare a code, from read_lines().

    A declaration is a line like owasp: A03 among the first 50, in quotes or not; a file's first one decides, and one that is no
    code leaves the case to the next file.
    """
    text = F.trim(F.regexp_replace("content", r"^\s+|\s+$", ""))
    place = F.array_position(F.array(*map(F.lit, DECLARING)), F.regexp_extract("path", "/gt/([^/]+)$", 1))
    rows = lines.where(F.col("line") <= DECLARING_LINES).withColumns({"text": text, "place": place}).where((F.col("place") > 0) & F.lower("text").startswith("owasp:"))
    columns = path_columns(F.col("path"))
    first = rows.withColumns({c: columns[c] for c in ("suite_id", "case_id")}).groupBy("suite_id", "case_id", "place").agg(F.min_by("text", "line").alias("text"))
    code = owasp_id(F.regexp_replace(F.trim(F.substring("text", 7, 1 << 20)), "^['\"]+|['\"]+$", ""))
    return first.withColumn("owasp_id", code).where("owasp_id IS NOT NULL").groupBy("suite_id", "case_id").agg(F.min_by("owasp_id", "place").alias("owasp_id"))
