"""Files that arrive one after the other give the tables of one run over all of them."""

from siftwell.operators import clustering
from siftwell.streaming.incremental import refresh_cases

ITEM = "suite_id string, case_id string, tool string, finding_id string, rule_id string, title string, severity string, issue_type string, file_path string, line_number int, end_line_number int, item_seq long"


def test_refresh(spark, tmp_path):
    def rows(case, lines, first):
        return spark.createDataFrame([("s", case, "t", str(k), "r", "x", "LOW", "", "f", line, line, first + k) for k, line in enumerate(lines)], ITEM)

    def make(items):
        return clustering.assign_clusters(items, 3).groupBy("suite_id", "case_id", "cluster_id").count()

    def step():
        refresh_cases(spark, f"{tmp_path}/in", f"{tmp_path}/store", f"{tmp_path}/out", ITEM, make, f"{tmp_path}/state").awaitTermination(120)
        return {(r["case_id"], r["cluster_id"], r["count"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    rows("a", [1, 20], 0).union(rows("b", [5], 0)).write.mode("append").parquet(f"{tmp_path}/in")
    assert step() == {("a", "f:1-1", 1), ("a", "f:20-20", 1), ("b", "f:5-5", 1)}
    rows("a", [3, 4], 10).write.mode("append").parquet(f"{tmp_path}/in")
    assert step() == {("a", "f:1-4", 3), ("a", "f:20-20", 1), ("b", "f:5-5", 1)}
