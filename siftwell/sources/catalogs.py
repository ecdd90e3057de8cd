"""Ground truth of many cases: catalogues and captured markers in each case's folder, and which of them counts.

A case's folder may hold gt_catalog.yaml (or .yml) and gt_markers.json; its repository may hold markers.  All documents of all cases
are read in one plan, and one more plan of counts by case says which source a case takes, or why it takes none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.groundtruth import CASE
from siftwell.sources.layout import path_columns

# The modes, other words for none, and the names of the documents, the first YAML name counts.
MODES = ("auto", "markers", "yaml", "none")
OFF = ("off", "none", "disable", "disabled")
YAML_NAMES, MARKERS_NAME = ("gt_catalog.yaml", "gt_catalog.yml"), "gt_markers.json"
_SCANNED, _CAPTURED, _YAML = "scanned", "captured", "yaml"


def _as_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """YAML texts as JSON, or what is wrong with them; JSON texts as they are."""
    try:
        import yaml
    except ImportError:
        yaml = None
    for batch in batches:
        found, errors = [], []
        for name, text in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
            value, error = text, None
            if name != MARKERS_NAME:
                value = None
                if yaml is None:
                    error = "no YAML library is installed"
                else:
                    try:
                        value = json.dumps(yaml.safe_load(text or ""), default=str)
                    except (yaml.YAMLError, ValueError, RecursionError) as e:
                        error = str(e)
            found.append(value)
            errors.append(error)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(errors, pa.string())], names=[*batch.schema.names[:-1], "value", "error"])


def documents(texts: DataFrame) -> DataFrame:
    """(suite_id, case_id, source, path, error, items) of texts (path, value) named .../suites/S/cases/C/gt/NAME; other paths are left out.

    items are the objects of a list, or of the list under items, as VARIANT; a document of another shape has none.  Where a case has
    both YAML names, the first is its catalogue.
    """
    columns, name = path_columns(F.col("path")), F.regexp_extract("path", "/gt/([^/]+)$", 1)
    named = texts.select(columns["suite_id"].alias("suite_id"), columns["case_id"].alias("case_id"), "path", name.alias("name"), "value").where(F.col("name").isin(*YAML_NAMES, MARKERS_NAME))
    read = named.mapInArrow(_as_json, "suite_id string, case_id string, path string, name string, value string, error string")
    listed = F.coalesce(F.from_json(F.when(F.ltrim("value").startswith("["), F.col("value")), "array<variant>"), F.from_json(F.get_json_object("value", "$.items"), "array<variant>"), F.array().cast("array<variant>"))
    items = F.filter(listed, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    source = F.when(F.col("name") == MARKERS_NAME, _CAPTURED).otherwise(_YAML)
    shaped = read.select(*CASE, source.alias("source"), "path", "name", "error", items.alias("items"))
    best = shaped.groupBy(*CASE, "source").agg(F.min("name").alias("name"))  # .yaml comes before .yml
    return shaped.join(best, [*CASE, "source", "name"], "left_semi").drop("name")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """documents() of the cases below root; a file of no bytes counts as missing, as Spark passes it over."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "gt_*").text(root, wholetext=True)
    return documents(texts.select(F.col("_metadata.file_path").alias("path"), "value"))


def mode_of(text: Column) -> Column:
    """A mode as users write it: other words for none count, and what is unknown is auto."""
    plain = F.lower(F.trim(F.coalesce(text, F.lit("auto"))))
    return F.when(plain.isin(*OFF), "none").when(plain.isin(*MODES), plain).otherwise("auto")


def choices(cases: DataFrame, found: DataFrame, scanned: DataFrame | None = None) -> DataFrame:
    """One row per case (suite_id, case_id, gt_source): its mode, the source it takes, or the reason why none, the number of items, and what was wrong with its catalogue.

    found: documents(); scanned: (suite_id, case_id, item) of markers found in repositories.  auto takes captured markers, then scanned
    ones, then the catalogue; markers the first two; yaml the catalogue alone.  taken tells captured and scanned markers apart.
    """
    kinds = [(_CAPTURED, "captured"), (_YAML, "listed")]
    counted = found.groupBy(*CASE).agg(
        *[F.sum(F.when(F.col("source") == source, F.size("items"))).alias(f"_{name}") for source, name in kinds],
        *[F.max(F.when(F.col("source") == _YAML, F.col(c))).alias(f"_{c}") for c in ("path", "error")],
    )
    rows = cases.select(*CASE, mode_of(F.col("gt_source")).alias("mode")).join(counted, CASE, "left")
    if scanned is not None:
        rows = rows.join(scanned.groupBy(*CASE).agg(F.count("*").alias("_scanned")), CASE, "left")
    n = {c: F.coalesce(f"_{c}", F.lit(0)) if c != "scanned" or scanned is not None else F.lit(0) for c in ("captured", "scanned", "listed")}
    mode, markers = F.col("mode"), F.col("mode").isin("auto", "markers")
    taken = F.when(markers & (n["captured"] > 0), _CAPTURED).when(markers & (n["scanned"] > 0), _SCANNED).when(mode.isin("auto", "yaml") & F.col("_error").isNull() & (n["listed"] > 0), _YAML)
    broken = F.when(F.col("_error").isNotNull(), "gt_catalog_yaml_error")
    why = (
        F.when(mode == "none", "gt_disabled")
        .when(mode == "markers", "no_gt_markers")
        .when(mode == "yaml", F.when(F.col("_path").isNull(), "no_gt_catalog_yaml").otherwise(F.coalesce(broken, F.lit("empty_gt_catalog_yaml"))))
        .otherwise(F.coalesce(broken, F.lit("no_gt")))
    )
    tried = (mode == "yaml") | ((mode == "auto") & F.coalesce(taken == _YAML, F.lit(True)))
    with_choice = rows.withColumn("taken", taken)
    used = F.when(F.col("taken").isin(_CAPTURED, _SCANNED), "markers").otherwise(F.col("taken"))
    number = F.when(F.col("taken") == _CAPTURED, n["captured"]).when(F.col("taken") == _SCANNED, n["scanned"]).when(F.col("taken") == _YAML, n["listed"]).otherwise(0)
    return with_choice.select(
        *CASE, F.col("mode").alias("gt_source_mode"), "taken", used.alias("gt_source_used"), F.when(F.col("taken").isNull(), why).alias("reason"), number.cast("bigint").alias("n_items"),
        F.when(tried, F.col("_path")).alias("gt_catalog_path"), F.when(tried, F.col("_error")).alias("error"),
    )


def _spelled(item: str) -> list[Column]:
    """The fields of an item under every name that they go by, as text, for groundtruth.normalize_items()."""
    return [F.try_variant_get(item, f"$.{c}", "string").alias(c) for c in ("gt_id", "id", "file", "file_path", "start_line", "line", "line_number", "end_line", "end", "track", "set_name", "set")]


def chosen_items(chosen: DataFrame, found: DataFrame, scanned: DataFrame | None = None) -> DataFrame:
    """The raw items of the source that each case takes, with its fields as text; give them to groundtruth.normalize_items()."""
    listed = found.select(*CASE, "source", F.explode("items").alias("item"))
    if scanned is not None:
        listed = listed.unionByName(scanned.select(*CASE, F.lit(_SCANNED).alias("source"), "item"))
    taken = chosen.where("taken IS NOT NULL").select(*CASE, F.col("taken").alias("source"))
    return listed.join(taken, [*CASE, "source"]).select(*CASE, "source", *_spelled("item"))


def write_catalog(items: DataFrame, path: str) -> None:
    """Normalised items as one table by suite and case; the cases written before keep theirs unless items has new ones."""
    items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CASE).parquet(path)
