"""Joins of ranges and ranks, where one file or case holds most of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siftwell.operators import clustering, groundtruth
from siftwell.operators.intervals import candidates

LEFT, RIGHT = "file string, l int, a long, b long", "file string, r int, c long, d long"


def pairs(df):
    return sorted((r["l"], r["r"]) for r in df.collect())


def ranges(rng, n, files, longest):
    out = []
    for k in range(n):
        start = rng.choice([rng.randrange(-50, 3_000), rng.randrange(0, 3_000_000)])
        out.append((rng.choice(files), k, start, start + rng.choice([0, 1, 7, 300, 511, 512, 9_000, longest]) * rng.choice([1, 1, -1])))
    return out


@pytest.mark.parametrize("reach", [0, 1, 200, 10_000])
def test_every_pair_within_reach_comes_once(spark, reach):
    rng = random.Random(reach)
    left = ranges(rng, 250, ["x", "y", "z", None], 600_000) + [("x", 900, None, 4), ("x", 901, 3, None)]
    right = ranges(rng, 120, ["x", "y", "w", None], 2**31) + [("x", 902, None, None)]
    found = candidates(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["file"], ("a", "b"), ("c", "d"), reach)
    assert set(found.columns) == {"file", "l", "a", "b", "r", "c", "d"}
    got = pairs(found)
    assert len(got) == len(set(got))  # candidates hold each pair once
    wanted = []
    for f, i, a, b in left:
        for g, j, c, d in right:
            if f == g and f is not None and None not in (a, b, c, d) and max(min(a, b), min(c, d) - reach) <= min(max(a, b), max(c, d) + reach):
                wanted.append((i, j))
    assert set(wanted) <= set(got)


def test_empty_sides(spark):
    one = spark.createDataFrame([("x", 1, 1, 1)], LEFT)
    assert candidates(one, spark.createDataFrame([], RIGHT), ["file"], ("a", "b"), ("c", "d")).count() == 0
    assert candidates(one.limit(0), spark.createDataFrame([("x", 1, 1, 1)], RIGHT), ["file"], ("a", "b"), ("c", "d")).count() == 0


@pytest.mark.parametrize("n", [2_000, 8_000])
def test_rows_examined_grow_with_the_hot_file(spark, n):
    """n short ranges on either side of one file, five lines apart: an equality join on the file would examine n * n."""
    left = spark.range(n).select(F.lit("hot").alias("file"), F.col("id").cast("int").alias("l"), (F.col("id") * 5).alias("a"), (F.col("id") * 5 + 2).alias("b"))
    right = left.select("file", F.col("l").alias("r"), (F.col("a") + 1).alias("c"), (F.col("b") + 1).alias("d"))
    long = spark.createDataFrame([("hot", -1, 0, 5 * n), ("hot", -2, 0, 2**31), ("hot", -3, 700, 1_400)], RIGHT)
    found = candidates(left, right.unionByName(long), ["file"], ("a", "b"), ("c", "d"))
    meets = found.where("greatest(a, c) <= least(b, d)").count()
    assert n + 2 * n <= meets and found.count() < 40 * n


def test_matches_equal_a_nested_loop(spark):
    rng = random.Random(4)
    case = ("s", "c")
    gt = [(*case, f"g{k}", rng.choice("xy"), a, a + rng.choice([0, 3, 900, 700_000]), "sast", "core") for k, a in enumerate(rng.randrange(3_000) for _ in range(60))]
    gt += gt[:2] + [(*case, "g0", "x", 1, 1, "sca", "core")]
    items = [(*case, rng.choice(["semgrep", "sonar", ""]), rng.choice("xyz"), rng.choice([None, rng.randrange(3_000), rng.randrange(800_000)])) for _ in range(500)]
    have = spark.createDataFrame(items, "suite_id string, case_id string, tool string, file_path string, line_number int")
    want = spark.createDataFrame(gt, "suite_id string, case_id string, gt_id string, file string, start_line int, end_line int, track string, set_name string")
    for tolerance in (0, 3):
        got = sorted((r["gt_id"], r["file"], r["start_line"], r["end_line"], r["matched_tools"]) for r in groundtruth.match_items(want, have, tolerance).collect())
        wanted = [(g, f, a, b, ",".join(sorted({t for _, _, t, p, n in items if t and p == f and a - tolerance <= (n or 0) <= b + tolerance}))) for _, _, g, f, a, b, *_ in gt]
        assert got == sorted(wanted)


def test_overlaps_equal_a_nested_loop(spark):
    rng = random.Random(6)
    clusters = [("s", "c", rng.choice("xy"), f"k{k}", a, None if a is None else a + rng.choice([-4, 0, 5, 2_000])) for k, a in enumerate(rng.choice([None, rng.randrange(4_000)]) for _ in range(200))]
    gt = [("s", "c", rng.choice("xy"), f"g{k}", "core", "sast", a, a + rng.choice([0, 3, 900, 700_000])) for k, a in enumerate(rng.randrange(4_000) for _ in range(60))]
    found = groundtruth.overlaps(
        spark.createDataFrame(clusters, "suite_id string, case_id string, file_path string, cluster_id string, start_line int, end_line int"),
        spark.createDataFrame(gt, "suite_id string, case_id string, file string, gt_id string, set_name string, track string, start_line int, end_line int"),
        (0, 2, 10),
    )
    wanted = []
    for _, _, f, k, a, b in clusters:
        for _, _, g, i, _, _, c, d in gt:
            gap = max((a or 0) - d, c - (b or 0))
            wanted += [(k, i, t) for t in (0, 2, 10) if f == g and gap <= t]
    assert sorted((r["cluster_id"], r["gt_id"], r["gt_tolerance"]) for r in found.collect()) == sorted(wanted)


def test_ranks_equal_those_of_a_window(spark):
    rng = random.Random(8)
    rows = [("s", rng.choice(["hot"] * 6 + ["a", "b"]), rng.choice([None, 0, 1, 2, 3]), rng.choice([1, 1, 1, 2]), rng.randrange(3), f"f{rng.randrange(50)}", rng.choice([None, 1, 7]), k, ["x"]) for k in range(3_000)]
    df = spark.createDataFrame(rows, "suite_id string, case_id string, max_severity_rank int, tool_count int, finding_count long, file_path string, start_line int, cluster_id int, tools array<string>").repartition(7)
    order = clustering.severity_order()
    wanted = df.withColumn("rank", F.row_number().over(Window.partitionBy("suite_id", "case_id").orderBy(*order)))
    found = clustering.ranked(df, order)
    assert found.columns == wanted.columns and found.schema["rank"].dataType == wanted.schema["rank"].dataType
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert clustering.ranked(df.limit(0), order).count() == 0


def test_no_range_holds_a_whole_hot_case(spark):
    """The rows of one case lie in as many ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.lit("s").alias("suite_id"), F.lit("hot").alias("case_id"), F.col("id").alias("v"))
        ranks = clustering.ranked(df, [F.desc("v")])
        assert ranks.where("rank <> 20000 - v").count() == 0
        plan = ranks._jdf.queryExecution().optimizedPlan().toString()
        assert "_range" in plan and "row_number" not in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
