"""Registered queries against their DuckDB SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from siftwell.plans.catalog import QUERIES
from siftwell.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def _value(v):
    if v is None or str(v) in ("<NA>", "nan", "NaT"):
        return None
    if isinstance(v, float) or hasattr(v, "dtype") and v.dtype.kind == "f":
        return int(v) if math.isfinite(v) and float(v).is_integer() else float(v)
    return v.item() if hasattr(v, "item") else v


def rows(frame):
    cols = sorted(frame.columns)
    return sorted((tuple(map(_value, r)) for r in frame[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    found, wanted = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert set(found.columns) == set(wanted.columns)
    assert rows(found) == rows(wanted)
    assert len(found) or name in ("gt_ambiguity",)


def test_entry_is_a_ranked_queue(spark):
    top = entry.entry(spark).where("rank = 1").collect()
    assert len(top) == 10 and all(r["max_severity"] == "HIGH" for r in top)
