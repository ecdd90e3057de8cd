"""Lenient readings of text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(value: Column) -> Column:
    """A whole number, or null: '12' is one, '12.0' is not."""
    return value.try_cast("int")


def cell_int(value: Column, default: int = 0) -> Column:
    """The whole part of a number in a cell; default for anything else."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(default))


def cell_float(value: Column, default: float | None = None) -> Column:
    number = value.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(default))


def _parts(value: Column, sep: str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")


def _listed(value: Column, fallback: Column) -> Column:
    """The nonblank strings of a JSON list, or the fallback where there are none."""
    items = F.filter(F.from_json(value, "array<string>"), lambda x: F.trim(x) != "")
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, items).otherwise(fallback)


def parse_tools(json_list: Column, plain: Column) -> Column:
    """Tools from a JSON list, else from a comma list."""
    return _listed(json_list, _parts(plain, ","))


def parse_ids(json_list: Column, plain: Column) -> Column:
    """Ids from a JSON list, else from a semicolon list."""
    return _listed(json_list, _parts(plain, ";"))


def parse_tool_counts(json_map: Column, tools: Column) -> Column:
    """Positive counts by tool from a JSON object; 1 for each tool where there is none."""
    counts = F.map_filter(F.from_json(json_map, "map<string,int>"), lambda k, v: v > 0)
    one_each = F.map_from_arrays(tools, F.transform(tools, lambda _: F.lit(1)))
    return F.when(F.coalesce(F.size(counts), F.lit(0)) > 0, counts).otherwise(one_each)


def sorted_json(counts: Column) -> Column:
    """A map as a JSON object with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(counts))))


def parse_candidates(raw: str) -> list[int]:
    """Distinct non-negative whole numbers from a list with commas, semicolons or spaces."""
    found = [int(x) for x in raw.replace(",", " ").replace(";", " ").split()]
    if any(x < 0 for x in found):
        raise ValueError("tolerances must be 0 or more")
    return list(dict.fromkeys(found))


def normalize_ks(ks: list[int]) -> list[int]:
    """Distinct positive cut-offs in order; the default ones if there are none."""
    return sorted({k for k in ks if k > 0}) or [1, 3, 5, 10, 25, 50]
