"""Ground-truth documents of many cases, and which source each case takes."""

import json

import pytest
from pyspark.sql import functions as F

from siftwell.operators import groundtruth
from siftwell.sources import catalogs
from tests.test_sources import put

pytest.importorskip("yaml")
ITEM = {"id": "j1", "file": "a.py", "line": 3}
YAML = "- id: y1\n  file: b.py\n  start_line: 1\n  end_line: 2\n- plain\n- {id: y2, file: ./c.py, line_number: '7', set: core}\n"
DOCUMENTS = {
    "both": {"gt_markers.json": [ITEM, "x", {"id": "j2"}], "gt_catalog.yaml": YAML},
    "wrapped": {"gt_markers.json": {"items": []}, "gt_catalog.yml": "items:\n" + YAML},
    "broken": {"gt_catalog.yaml": "items: [", "gt_catalog.yml": YAML, "gt_markers.json": "not json"},
    "empty": {"gt_catalog.yaml": "# none\n", "other.yaml": YAML},
    "shape": {"gt_catalog.yaml": "items: text", "gt_markers.json": {"items": {"a": 1}}},
    "dates": {"gt_catalog.yaml": "- {id: d, file: d.py, line: 2024-01-02}\n"},
    "nothing": {"gt_catalog.yaml": ""},
    "scanned": {"gt_catalog.yaml": YAML},
}


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("gt")
    for case, files in DOCUMENTS.items():
        for name, value in files.items():
            put(root, f"suites/s/cases/{case}/gt/{name}", value)
    return catalogs.read_documents(spark, str(root)).cache()


def marked(spark):
    rows = [("s", "scanned", json.dumps({"gt_id": "m1", "file": "m.py", "line": 9})), ("s", "both", json.dumps({"gt_id": "m2", "file": "m.py"}))]
    return spark.createDataFrame(rows, "suite_id string, case_id string, item string").withColumn("item", F.parse_json("item"))


def chosen(spark, found, mode, scanned=None):
    cases = spark.createDataFrame([("s", c, mode) for c in DOCUMENTS], "suite_id string, case_id string, gt_source string")
    return catalogs.choices(cases, found, scanned)


def test_documents(found):
    got = {(r["case_id"], r["source"]): (len(r["items"]), r["error"] is not None, r["path"].rpartition("/")[2]) for r in found.collect()}
    assert got == {
        ("both", "captured"): (2, False, "gt_markers.json"), ("both", "yaml"): (2, False, "gt_catalog.yaml"), ("wrapped", "captured"): (0, False, "gt_markers.json"), ("wrapped", "yaml"): (2, False, "gt_catalog.yml"),
        ("broken", "captured"): (0, False, "gt_markers.json"), ("broken", "yaml"): (0, True, "gt_catalog.yaml"), ("empty", "yaml"): (0, False, "gt_catalog.yaml"),
        ("shape", "captured"): (0, False, "gt_markers.json"), ("shape", "yaml"): (0, False, "gt_catalog.yaml"), ("dates", "yaml"): (1, False, "gt_catalog.yaml"), ("scanned", "yaml"): (2, False, "gt_catalog.yaml"),
    }


EXPECTED = {
    "auto": {"both": ("markers", None, 2), "wrapped": ("yaml", None, 2), "broken": (None, "gt_catalog_yaml_error", 0), "empty": (None, "no_gt", 0), "shape": (None, "no_gt", 0), "dates": ("yaml", None, 1), "nothing": (None, "no_gt", 0), "scanned": ("markers", None, 1)},
    "markers": {"both": ("markers", None, 2), "scanned": ("markers", None, 1)} | {c: (None, "no_gt_markers", 0) for c in ("wrapped", "broken", "empty", "shape", "dates", "nothing")},
    "yaml": {"both": ("yaml", None, 2), "wrapped": ("yaml", None, 2), "broken": (None, "gt_catalog_yaml_error", 0), "empty": (None, "empty_gt_catalog_yaml", 0), "shape": (None, "empty_gt_catalog_yaml", 0), "dates": ("yaml", None, 1), "nothing": (None, "no_gt_catalog_yaml", 0), "scanned": ("yaml", None, 2)},
    "none": {c: (None, "gt_disabled", 0) for c in DOCUMENTS},
}


@pytest.mark.parametrize(("text", "mode"), [("auto", "auto"), (None, "auto"), ("odd", "auto"), (" Markers ", "markers"), ("YAML", "yaml"), ("disabled", "none"), ("off", "none")])
def test_choices(spark, found, text, mode):
    rows = chosen(spark, found, text, marked(spark)).collect()
    assert {r["case_id"]: (r["gt_source_used"], r["reason"], r["n_items"]) for r in rows} == EXPECTED[mode]
    assert {r["gt_source_mode"] for r in rows} == {mode}
    wrong = {r["case_id"] for r in rows if r["error"]}
    assert wrong == ({"broken"} if mode in ("auto", "yaml") else set())


def test_without_scanned_markers(spark, found):
    got = {r["case_id"]: (r["gt_source_used"], r["taken"]) for r in chosen(spark, found, "auto").collect()}
    assert got["scanned"] == ("yaml", "yaml") and got["both"] == ("markers", "captured")
    assert catalogs.choices(spark.createDataFrame([], "suite_id string, case_id string, gt_source string"), found).count() == 0


def test_items_of_the_choice(spark, found, tmp_path):
    scanned = marked(spark)
    raw = catalogs.chosen_items(chosen(spark, found, "auto", scanned), found, scanned)
    items = groundtruth.normalize_items(raw)
    got = sorted((r["case_id"], r["gt_id"], r["file"], r["start_line"], r["end_line"], r["set_name"]) for r in items.collect())
    wanted = [("both", "j1", "a.py", 3, 3, "unknown"), ("dates", "d", "d.py", 0, 0, "unknown"), ("scanned", "m1", "m.py", 9, 9, "unknown"), ("wrapped", "y1", "b.py", 1, 2, "unknown"), ("wrapped", "y2", "c.py", 7, 7, "core")]
    assert got == wanted  # j2 has no file
    catalogs.write_catalog(items, f"{tmp_path}/gold")
    catalogs.write_catalog(items.where("case_id = 'both'").withColumn("gt_id", F.lit("new")), f"{tmp_path}/gold")
    assert sorted(r["gt_id"] for r in spark.read.parquet(f"{tmp_path}/gold").collect()) == ["d", "m1", "new", "y1", "y2"]
