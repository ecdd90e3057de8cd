"""Checks of a suite's inputs: fields that findings lack, runs without findings, scanners' configurations, and the features' table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.contract import EXPECTED, is_blank
from siftwell.operators.groundtruth import CASE
from siftwell.operators.triage import SCHEMA_VERSION


def schema_gaps(findings: DataFrame, fields: tuple[str, ...] = EXPECTED) -> DataFrame:
    """(suite_id, tool, field, findings, missing): how many findings of a tool lack a field, over all of them."""
    counts = findings.groupBy("suite_id", "tool").agg(F.count("*").alias("findings"), *[F.count_if(is_blank(c)).alias(c) for c in fields])
    return counts.unpivot(["suite_id", "tool", "findings"], list(fields), "field", "missing").select("suite_id", "tool", "field", "findings", "missing")


def empty_runs(runs: DataFrame, findings: DataFrame) -> DataFrame:
    """The runs (suite_id, case_id, tool) that have no finding."""
    return runs.select(*CASE, "tool").distinct().join(findings, [*CASE, "tool"], "left_anti")


def context_mismatches(cases: DataFrame) -> DataFrame:
    """(suite_id, case_id, field, expected, actual) where a case's repository isn't in the state that was expected.

    Columns expected_<field> and actual_<field> are compared for the fields branch and commit; blank expectations say nothing.
    """
    fields = ("branch", "commit")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"expected_{f}").alias("expected"), F.col(f"actual_{f}").alias("actual")) for f in fields])
    rows = cases.select(*CASE, F.inline(each))
    return rows.where((F.coalesce("expected", F.lit("")) != "") & ~F.col("expected").eqNullSafe(F.col("actual")))


def _text(values: Column) -> Column:
    """A list as the reports write it: ['a', 'b']."""
    return F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']"))


def scanner_config(receipts: DataFrame, tools: tuple[str, ...] = ()) -> DataFrame:
    """One row per suite of what its receipts (suite_id, tool, profile, config_hash) say.

    profile is the only one seen, mixed, or null; config_hashes lists each tool's distinct signatures; tools are those
    requested.  Receipts without a tool are counted only.
    """
    tool, profile = F.trim(F.coalesce("tool", F.lit(""))), F.trim(F.coalesce("profile", F.lit("")))
    by_tool = receipts.groupBy("suite_id", tool.alias("tool")).agg(F.count("*").alias("n"), F.collect_set(F.when(profile != "", profile)).alias("profiles"), F.array_sort(F.collect_set("config_hash")).alias("hashes"))
    named = F.col("tool") != ""
    rows = by_tool.groupBy("suite_id").agg(
        F.sum("n").alias("receipts_found"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(named, F.col("profiles")))))).alias("profiles"),
        F.array_sort(F.collect_list(F.when(named & (F.size("hashes") > 0), F.struct("tool", "hashes")))).alias("config_hashes"),
    )
    seen = F.col("config_hashes.tool")
    many = F.transform(F.filter("config_hashes", lambda x: F.size(x["hashes"]) > 1), lambda x: x["tool"])
    wanted = F.array_sort(F.array_distinct(F.array(*map(F.lit, tools)))) if tools else F.array().cast("array<string>")
    rows = rows.withColumns({"tools_seen": seen, "missing_tools": F.array_except(wanted, seen), "_many": many})
    n = F.size("profiles")
    warnings = F.array_compact(F.array(
        F.when(n > 1, F.concat(F.lit("multiple profiles observed: "), _text(F.col("profiles")))),
        F.when(F.size("missing_tools") > 0, F.concat(F.lit("missing config_receipt for tools: "), _text(F.col("missing_tools")))),
        F.when(F.size("_many") > 0, F.concat(F.lit("multiple config signatures detected for tools: "), _text(F.col("_many")))),
    ))
    return rows.select(
        "suite_id", F.when(n == 1, F.get("profiles", F.lit(0))).when(n > 1, "mixed").alias("profile"), F.when(n == 1, "uniform").when(n > 1, "mixed").otherwise("unknown").alias("profile_mode"),
        "config_hashes", "receipts_found", "tools_seen", "missing_tools", warnings.alias("warnings"),
    )


def dataset(parts: list[DataFrame], suite_id: str, known: list[str]) -> DataFrame:
    """The features of all cases as one table, ordered by case and cluster; parts may differ in their columns.

    Columns: the ids, the known ones, then others by name; what a part lacks is null.  Blank suite ids and schema
    versions are filled in.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    lacking = [c for c in ("suite_id", "case_id", "cluster_id", *known) if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in dict.fromkeys(lacking)})
    filled = {"suite_id": suite_id, "schema_version": SCHEMA_VERSION}
    rows = rows.withColumns({c: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", F.lit(v)).otherwise(F.col(c)) for c, v in filled.items() if c in rows.columns})
    order = dict.fromkeys(["suite_id", "case_id", "cluster_id", *known, *sorted(rows.columns)])
    return rows.select(*order).orderBy("case_id", "cluster_id")


def dataset_audit(planned: DataFrame, tables: DataFrame, features: DataFrame) -> DataFrame:
    """(suite_id, case_id, status, n_rows, schema_version) of every planned case.

    tables: (suite_id, case_id) of the feature tables that exist.  Status: missing (no table), empty (no rows), mismatch
    (rows of another schema version, the smallest of which is given) or ok.
    """
    version = F.trim(F.coalesce("schema_version", F.lit("")))
    other = F.min(F.when((version != "") & (version != SCHEMA_VERSION), version))
    counts = features.groupBy(*CASE).agg(F.count("*").alias("n_rows"), other.alias("schema_version"))
    rows = planned.join(tables.select(*CASE).distinct().withColumn("_there", F.lit(True)), CASE, "left").join(counts, CASE, "left")
    n = F.coalesce("n_rows", F.lit(0))
    status = F.when(F.col("_there").isNull() & (n == 0), "missing").when(n == 0, "empty").when(F.col("schema_version").isNotNull(), "mismatch").otherwise("ok")
    return rows.select(*CASE, status.alias("status"), n.alias("n_rows"), F.when(n > 0, F.coalesce("schema_version", F.lit(SCHEMA_VERSION))).alias("schema_version"))
