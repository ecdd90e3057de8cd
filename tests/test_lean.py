"""Clusters from one exchange, items beside clusters, rankings from profiles, cheap paths: all against the plain way."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.functions import paths
from siftwell.operators import clustering, evaluation, groundtruth
from siftwell.plans.suite import Suite
from siftwell.sinks import shared

ITEM = "suite_id string, case_id string, tool string, finding_id string, rule_id string, title string, severity string, issue_type string, file_path string, line_number int, end_line_number int, item_seq long"
GT = "suite_id string, case_id string, gt_id string, file string, start_line int, end_line int, track string, set_name string"
TOOLS = ("semgrep", "snyk", "sonar")


def findings(spark, rng, n=300, back=0):
    def row(k):
        a = rng.choice([None, 0, *[rng.randrange(1, 90)] * 8])
        end = rng.choice([None, (a or 0) + rng.randrange(-back, 5)])
        return ("s", rng.choice(["owasp2021-a01-case", "plain"]), rng.choice([*TOOLS, "other", None]), rng.choice(["", f"F{k % 40}"]), rng.choice([None, "", "r1", "r2"]), rng.choice(["t", "u"]), rng.choice(["HIGH", " low", "x", None]), "VULNERABILITY", rng.choice(["x", "y", "d/z"]), a, end, k)

    return spark.createDataFrame([row(k) for k in range(n)], ITEM)


def items_of(spark, rng, n, files=("x", "y", "d/z")):
    return spark.createDataFrame([("s", rng.choice(["owasp2021-a01-case", "plain"]), rng.choice(["", f"g{rng.randrange(20)}"]), rng.choice(files), a, a + rng.randrange(4), "sast", "core") for a in (rng.randrange(1, 99) for _ in range(n))], GT)


def same(a, b):
    assert set(a.columns) == set(b.columns)
    return sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize(("back", "crowd"), [(0, 1 << 20), (9, 1 << 20), (0, 5)])
def test_clusters_of_one_exchange(spark, monkeypatch, back, crowd):
    monkeypatch.setattr(clustering, "CROWD", crowd)
    rows = findings(spark, random.Random(back), back=back)
    found = clustering.clusters_of(rows, 1, TOOLS)
    assert same(found, clustering.summarize_clusters(clustering.assign_clusters(rows, 1), TOOLS))
    assert clustering.clusters_of(rows.limit(0), 1, TOOLS).count() == 0
    if not back and crowd > 5:
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("few", [0, 3, 64])
def test_items_near_clusters(spark, monkeypatch, few):
    monkeypatch.setattr(groundtruth, "FEW", few)
    rng = random.Random(few)
    clusters, gt = clustering.clusters_of(findings(spark, rng), 1, TOOLS), items_of(spark, rng, 12)
    near = groundtruth.with_near(clusters, gt, 2)
    flat = near.select("suite_id", "case_id", "cluster_id", F.explode("near").alias("n")).select("suite_id", "case_id", "cluster_id", "n.gt_id", "n.set_name", "n.track", "n.gap")
    wanted = groundtruth.nearest(clusters, gt, 2)
    assert wanted.count() and same(flat, wanted) and near.count() == clusters.count()


def test_rankings_of_profiles_equal_those_of_all_rows(spark):
    rng = random.Random(5)
    config = AnalysisConfig(tools=TOOLS, tolerance=0, ks=(1, 3, 7))
    suite = Suite(findings(spark, rng, 400), items_of(spark, rng, 30), config, lean=True)
    order = {"baseline": clustering.severity_order(), "agreement": clustering.agreement_order()}
    for most in (1, 7, 1_000):
        got = evaluation.rankings(suite.rows, suite.model, config, most)
        for name, by in order.items():
            wanted = evaluation._ranks(suite.rows, ["suite_id", "case_id"], by, most).select("case_id", "rank", "cluster_id")
            assert same(got.where(F.col("strategy") == name).select("case_id", "rank", "cluster_id"), wanted)
        scored = evaluation.with_score(suite.rows, suite.model, config.calibration, name="score")
        wanted = evaluation._ranks(scored, ["suite_id", "case_id"], [F.desc(F.coalesce("score", F.lit(0.0))), *clustering.severity_order()], most)
        assert same(got.where("strategy = 'calibrated'").select("case_id", "rank", "cluster_id", F.col("triage_score_v1").alias("score")), wanted.select("case_id", "rank", "cluster_id", "score"))


def test_lean_suites_write_no_findings(spark, monkeypatch, tmp_path):
    """What evaluation writes holds no column of single findings, and no shuffle file outlives its table."""
    monkeypatch.setattr(shared, "folder", lambda _: f"file://{tmp_path}")
    rng = random.Random(6)
    found, gt = findings(spark, rng), items_of(spark, rng, 20)
    lean, full = Suite(found, gt, AnalysisConfig(tools=TOOLS), lean=True), Suite(found, gt, AnalysisConfig(tools=TOOLS))
    assert lean.by_case.count()
    written = [set(spark.read.parquet(f"file://{p}").columns) for p in Path(tmp_path).iterdir()]
    assert written and not any(c & {"finding_id", "item_seq", "rule_id", "sample"} for c in written)
    for name in ("by_case", "marginal", "utility", "weights_by_owasp", "topk"):
        assert same(getattr(lean, name), getattr(full, name))


def test_plain_paths_take_no_expressions(spark):
    odd = ["a/b.py", "", None, " a", "a ", "a\t", "\\x\\repo\\y", "c:/x", "./a", "././a", "/a", "a//b", "x/Repo/y", "repo/a", "a/repo", "a/repo/", "benchmark", "benchmark/x", "xbenchmark", "./benchmark/x", "x/benchmark", "a\u00a0", "\u00e9:/b"]
    df = spark.createDataFrame([(x,) for x in odd], "p string")
    for name in ("", "repo"):
        got = df.select(paths.normalize_file_path(F.col("p"), name).alias("a"), paths._normalized(F.col("p"), name).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in got)
    place = paths.as_prefix(F.col("p"))
    got = df.select("p", paths.is_excluded(F.col("p"), ("benchmark", "a/repo")).alias("a"), ((place == "benchmark") | place.startswith("benchmark/") | (place == "a/repo") | place.startswith("a/repo/")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and {r["a"] for r in got} == {True, False}
