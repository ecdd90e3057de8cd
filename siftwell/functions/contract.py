"""What a normalised finding must look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields that every finding needs, those that reports are checked for, and the severities.
REQUIRED = ("finding_id", "rule_id", "title")
EXPECTED = (*REQUIRED, "file_path", "line_number", "severity")
SEVERITIES = ("HIGH", "MEDIUM", "LOW")
#: Lists whose order means nothing.
SETS = ("cwe_ids",)
BLOCKS = tuple(f"owasp_top_10_{year}{view}" for year in (2017, 2021) for view in ("", "_vendor", "_canonical"))


def is_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def problems() -> Column:
    """What is wrong with a finding, as texts: missing fields, an unknown severity, lines that aren't numbers; empty if nothing is."""
    found = [F.when(is_blank(c), F.lit(f"missing:{c}")) for c in REQUIRED]
    found.append(F.when(~is_blank("severity") & ~F.col("severity").isin(*SEVERITIES), F.lit("invalid:severity")))
    found += [F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("int").isNull(), F.lit(f"invalid:{c}")) for c in ("line_number", "end_line_number")]
    return F.array_compact(F.array(*found))


def finding_order() -> list[Column]:
    """The order of findings within a report: a missing line comes first."""
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("file_path", "rule_id", "title", "finding_id")}
    lines = [F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(-1)) for c in ("line_number", "end_line_number")]
    return [blank["file_path"], *lines, blank["rule_id"], blank["title"], blank["finding_id"]]


def finalized(findings: DataFrame, keys: tuple[str, ...] = ("suite_id", "case_id", "tool")) -> DataFrame:
    """findings in a fixed order by report, with their lists sorted: equal reports give equal tables."""
    def in_order(value: Column) -> Column:
        return F.array_sort(F.array_compact(value))

    lists = {c: in_order(F.col(c)) for c in SETS if c in findings.columns}
    lists |= {c: F.col(c).withField("codes", in_order(F.col(f"{c}.codes"))).withField("categories", in_order(F.col(f"{c}.categories"))) for c in BLOCKS if c in findings.columns}
    return findings.withColumns(lists).orderBy(*keys, *finding_order())
