"""Results as files: tables in order, a suite's tables with their manifest, and the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.operators import agreement, evaluation, mart, report
from siftwell.plans.suite import Suite

#: What write_suite() writes, by name, with the columns that order a table.
TABLES: dict[str, tuple[Callable[[Suite], DataFrame], tuple[str | Callable[[], Column], ...]]] = {
    "clusters": (lambda s: s.clusters, ("suite_id", "case_id", "cluster_id")),
    "triage_queue": (lambda s: s.queue, ("suite_id", "case_id", "rank")),
    "triage_features": (lambda s: s.stored_features, ("suite_id", "case_id", "cluster_id")),
    "gt_score": (lambda s: s.matches, ("suite_id", "case_id", "gt_id")),
    "gt_gap_queue": (lambda s: s.gaps, ("suite_id", "case_id", "gt_id")),
    "triage_calibration": (lambda s: s.weights, ("suite_id", "tool")),
    "triage_calibration_by_owasp": (lambda s: s.weights_by_owasp, ("suite_id", "owasp_id", "tool")),
    "triage_eval_topk": (lambda s: s.topk, ("suite_id", "case_id", "strategy", "rank")),
    "triage_eval_by_case": (lambda s: s.by_case, ("suite_id", "case_id", "strategy", "k")),
    "triage_tool_utility": (lambda s: s.utility, ("suite_id", "tool")),
    "triage_tool_marginal": (lambda s: s.marginal, ("suite_id", "tool", lambda: evaluation.strategy_place(F.col("strategy")), "k")),
    "benchmark_pack": (lambda s: report.benchmark_pack(s.queue, agreement.consensus_queue(s.clusters, s.config.tools)), ("suite_id", "case_id")),
}


def flat(df: DataFrame) -> DataFrame:
    """df with lists, maps and structs as JSON texts, as CSV needs it."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested})


def write_table(df: DataFrame, path: str, formats: tuple[str, ...] = ("parquet",), order: tuple[str | Column, ...] = ()) -> None:
    """df under path/<format> for each of parquet, csv and json, in the order of some columns over all its files.

    Each format replaces what was there when it is complete, by Spark's commit; null is an empty cell of CSV.
    """
    rows = df.orderBy(*order) if order else df
    for form in formats:
        if form not in ("parquet", "csv", "json"):
            raise ValueError(f"unknown format {form}")
        out = (flat(rows) if form == "csv" else rows).write.mode("overwrite")
        (out.option("header", True).option("escape", '"') if form == "csv" else out).format(form).save(f"{path}/{form}")


def write_suite(suite: Suite, root: str, names: tuple[str, ...] = tuple(TABLES), formats: tuple[str, ...] = ("parquet",)) -> DataFrame:
    """The named tables of a suite under root/<name>, and their manifest, which is returned: (name, path, columns, formats)."""
    entries = []
    for name in names:
        make, order = TABLES[name]
        df = make(suite)
        write_table(df, f"{root}/{name}", formats, tuple(c() if callable(c) else c for c in order))
        entries.append((name, f"{root}/{name}", df.columns, list(formats)))
    manifest = suite.findings.sparkSession.createDataFrame(entries, "name string, path string, columns array<string>, formats array<string>")
    write_table(manifest, f"{root}/manifest", ("json",), ("name",))
    return manifest


def write_mart(suite: Suite, root: str, benchmark_id: str, runs: DataFrame | None = None) -> list[str]:
    """The star schema under root, every table by suite_run_id; names of what was written.  runs: the suite's tool runs (see provenance.tool_runs).

    Only the partitions of this suite run are replaced, so that suites share one root.
    """
    config = suite.config
    tables = {
        "fact_eval_case_k": mart.fact_eval_case_k(suite.by_case, benchmark_id),
        "fact_eval_suite_k": mart.fact_eval_suite_k(suite.macro, suite.micro, benchmark_id),
        "fact_tool_value": mart.fact_tool_value(suite.utility, suite.marginal, benchmark_id),
        "dim_suite_run": mart.dim_suite_run(suite.findings, benchmark_id, config.tolerance, config.gt_tolerance, config.mode),
        "dim_case": mart.dim_case(suite.cases, benchmark_id),
    }
    if runs is not None:
        tables["dim_tool_run"] = mart.dim_tool_run(runs, benchmark_id)
    for name, df in tables.items():
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("suite_run_id").parquet(f"{root}/{name}")
    return list(tables)
