"""How well rankings put clusters with ground truth first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.functions.parsing import parse_ids, parse_tool_counts, parse_tools
from siftwell.functions.scoring import ratio, round6
from siftwell.operators import clustering
from siftwell.operators.calibration import with_score
from siftwell.operators.clustering import agreement_order, severity_order
from siftwell.operators.groundtruth import CASE, near_values
from siftwell.operators.triage import with_owasp
from siftwell.sinks.shared import stored

STRATEGIES = ("baseline", "agreement", "calibrated_global", "calibrated")


def read_features(features: DataFrame) -> DataFrame:
    """The columns of the feature table that evaluation needs, with lists and maps as such."""
    tools = parse_tools(F.col("tools_json"), F.col("tools"))
    return features.select(
        *CASE, "cluster_id", "owasp_id", "file_path", "start_line", tools.alias("tools"), "tool_count", "finding_count", "max_severity", "max_severity_rank", "triage_rank", "gt_overlap",
        parse_ids(F.col("gt_overlap_ids_json"), F.col("gt_overlap_ids")).alias("gt_ids"), parse_tool_counts(F.col("tool_counts_json"), tools).alias("tool_counts"),
    )


def rows_of(near: DataFrame, config: AnalysisConfig) -> DataFrame:
    """The same columns but triage_rank straight from clusters with labels (see with_labels), without a feature table."""
    counts = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, sorted(config.tools))), F.array(*[F.col(f"{t}_count").cast("int") for t in sorted(config.tools)])), lambda t, n: n > 0)
    tools = F.col("named_tools")
    return near.select(
        *CASE, "cluster_id", F.coalesce("owasp_id", F.lit("")).alias("owasp_id"), "file_path", F.coalesce("start_line", F.lit(0)).alias("start_line"), tools.alias("tools"), "tool_count", "finding_count", "max_severity", "max_severity_rank",
        "gt_overlap", "gt_ids", F.when(F.size(counts) > 0, counts).otherwise(F.map_from_arrays(tools, F.transform(tools, lambda _: F.lit(1)))).alias("tool_counts"),
    )


def with_labels(near: DataFrame, config: AnalysisConfig, declared: DataFrame | None = None) -> DataFrame:
    """Clusters with the items near them (groundtruth.with_near) and what evaluation reads again and again: owasp_id, named_tools, gt_overlap, gt_ids."""
    rows = with_owasp(near, declared).withColumn("_ids", near_values("gt_id", config.gt_tolerance))
    named = {c: F.filter(x, lambda t: F.trim(t) != "") for c, x in (("named_tools", "tools"), ("gt_ids", "_ids"))}
    return rows.withColumns({**named, "gt_overlap": F.when(F.size("_ids") > 0, 1).otherwise(0)}).drop("_ids")


def cases(rows: DataFrame, gt: DataFrame) -> DataFrame:
    """(case, n_clusters, has_gt, gt_total) of every case with clusters or ground truth."""
    sizes = rows.groupBy(*CASE).agg(F.count("*").alias("n_clusters"), F.count_if(F.col("gt_overlap") == 1).alias("positives"))
    totals = gt.where("gt_id <> ''").groupBy(*CASE).agg(F.count_distinct("gt_id").alias("gt_total"))
    both = sizes.join(totals, CASE, "full_outer").na.fill(0, ["n_clusters", "positives", "gt_total"])
    return both.withColumn("has_gt", F.when(F.col("gt_total") > 0, 1).otherwise(0))


def classify_cases(found: DataFrame) -> DataFrame:
    """Flags of each case: what it lacks for an evaluation."""
    with_gt, empty = F.col("has_gt") == 1, F.col("n_clusters") == 0
    return found.select(
        *CASE, "n_clusters", "gt_total", with_gt.alias("with_gt"), (~with_gt).alias("without_gt"), empty.alias("no_clusters"), (with_gt & empty).alias("gt_but_no_clusters"),
        (with_gt & ~empty & (F.col("positives") == 0)).alias("gt_but_no_overlaps"),
    )


def _ranks(rows: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first most rows of each group: Spark keeps no more than that per task before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)


def _orders(strategies: tuple[str, ...], use_triage_rank: bool) -> dict[str, list[Column]]:
    by_rank = [F.asc(F.when(F.col("_any_rank"), F.coalesce("triage_rank", F.lit(10**9))).otherwise(0))] if use_triage_rank else []
    found = {"baseline": by_rank + severity_order(), "agreement": agreement_order()}
    return {s: found[s] for s in strategies}


def rankings(rows: DataFrame, model: DataFrame | None, config: AnalysisConfig, most: int, keys: tuple[str, ...] = ("suite_id", "case_id"), strategies: tuple[str, ...] = STRATEGIES, use_triage_rank: bool = True) -> DataFrame:
    """(strategy, rank) of the first most clusters of each case by each strategy.

    The baseline follows triage_rank where a case has any and no model exists, as a model's queue is calibrated.
    """
    use = use_triage_rank and model is None
    if use:
        rows = rows.join(rows.groupBy(*keys).agg(F.max(F.col("triage_rank") > 0).alias("_any_rank")), list(keys))
    if model is None:
        return _by_strategy(rows, _orders(tuple(s for s in strategies if not s.startswith("calibrated")), use), list(keys), most)
    kinds = profiles(rows)
    scored = with_score(kinds, model, config.calibration, name="_score")
    scored = with_score(scored, model, config.calibration, by_owasp=False, name="_score_all") if "calibrated_global" in strategies else scored
    return placed(rows, stored(contenders(scored, strategies, list(keys), most)), list(keys), most)


#: What tells apart clusters of a case that rank alike but for their place in the code.
PROFILE = [*CASE, "owasp_id", "tools", "tool_count", "finding_count", "max_severity", "max_severity_rank"]


def profiles(rows: DataFrame, *more: str) -> DataFrame:
    """The different profiles of rows, with further columns, and how many rows have each (_n): written, as later plans read them more than once."""
    return stored(rows.groupBy(*PROFILE, *more).agg(F.count("*").alias("_n")))


def contenders(scored: DataFrame, strategies: tuple[str, ...], keys: list[str], most: int) -> DataFrame:
    """The profiles of which a row may be among the first most of its keys by a strategy, each with the list of what it may enter.

    scored: profiles, and _score or _score_all where a strategy ranks by it.  Before a row come all rows with a greater lead (score,
    severity, agreement, size), so a profile counts as long as fewer than most have one.  At most that many leads of
    the same keys are looked at.
    """
    by_severity, by_tools = ("max_severity_rank", "tool_count", "finding_count"), ("tool_count", "max_severity_rank", "finding_count")
    order = {"baseline": (None, by_severity), "agreement": (None, by_tools), "calibrated_global": ("_score_all", by_severity), "calibrated": ("_score", by_severity)}

    def entry(strategy: str) -> Column:
        score, lead = order[strategy]
        value = F.col(score) if score else F.lit(None).cast("double")
        return F.struct(F.lit(strategy).alias("strategy"), value.alias("score"), F.struct(F.coalesce(value, F.lit(0.0)).alias("s"), *[F.col(c).cast("bigint").alias(f"v{k}") for k, c in enumerate(lead)]).alias("lead"))

    by = [*keys, "strategy"]
    own = [k for k in keys if k not in CASE]
    each = scored.withColumn("_e", F.explode(F.array(*map(entry, strategies)))).select(*_profile_of(scored), *own, "_n", "_e.strategy", "_e.score", "_e.lead")
    leads = _ranks(each.groupBy(*by, "lead").agg(F.sum("_n").alias("_n")), by, [F.desc("lead")], most)
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    enough = leads.withColumn("_before", before).where(F.coalesce("_before", F.lit(0)) < most).select(*by, "lead")
    return each.join(enough, [*by, "lead"], "left_semi").groupBy(*_profile_of(scored)).agg(F.collect_list(F.struct(*own, "strategy", "score", "lead")).alias("_entries"))


def _profile_of(df: DataFrame) -> list[str]:
    """The profile's columns of df: those of the row itself where df has others by the same names."""
    return [f"_of_{c}" if f"_of_{c}" in df.columns else c for c in [*PROFILE, "_counts"] if c in df.columns or f"_of_{c}" in df.columns]


def placed(rows: DataFrame, found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first most rows of each keys and strategy among those whose profile is in contenders(), with rank and triage_score_v1."""
    own = {c: f"_p_{c.removeprefix('_of_')}" for c in found.columns if c != "_entries"}
    same = reduce(Column.__and__, [F.col(p).eqNullSafe(F.col(p.removeprefix("_p_"))) for p in own.values()])
    met = rows.join(found.withColumnsRenamed(own), same)
    each = met.select(*rows.columns, F.inline("_entries"))
    ranked = _ranks(each, [*keys, "strategy"], [F.desc("lead"), F.asc("file_path"), F.asc(F.coalesce("start_line", F.lit(0))), F.asc("cluster_id")], most)
    return ranked.withColumnRenamed("score", "triage_score_v1").drop("lead")


def _by_strategy(rows: DataFrame, orders: dict[str, list[Column]], keys: list[str], most: int) -> DataFrame:
    found = None
    for strategy, order in orders.items():
        part = _ranks(rows, keys, order, most).withColumns({"strategy": F.lit(strategy), "triage_score_v1": F.lit(None).cast("double")}).drop("_any_rank")
        found = part if found is None else found.unionByName(part)
    return found


def rankings_at(rows: DataFrame, models: DataFrame, config: AnalysisConfig, most: int, tolerances: tuple[int, ...]) -> DataFrame:
    """rankings() of each tolerance, from rows with hits (see tolerance.labels) and a model keyed by gt_tolerance as well.

    Orders that no model enters are the same at every tolerance, so they are ranked once.  The tolerances multiply profiles, not rows.
    """
    every, by = F.explode(F.array(*map(F.lit, tolerances))), ("suite_id", "gt_tolerance")
    kinds = profiles(rows)
    fixed = contenders(kinds, tuple(s for s in STRATEGIES if not s.startswith("calibrated")), CASE, most)
    scored = kinds.withColumn("gt_tolerance", every)
    for name, by_owasp in (("_score", True), ("_score_all", False)):
        scored = with_score(scored, models, config.calibration, by_owasp, name, by)
    moving = contenders(scored, tuple(s for s in STRATEGIES if s.startswith("calibrated")), [*CASE, "gt_tolerance"], most)
    still = placed(rows, stored(fixed), CASE, most).withColumn("gt_tolerance", every)
    both = still.unionByName(placed(rows, stored(moving), [*CASE, "gt_tolerance"], most))
    gt_ids = F.transform(F.filter("hits", lambda h: h["gt_tolerance"] <= F.col("gt_tolerance")), lambda h: h["gt_id"])
    return both.withColumn("gt_ids", gt_ids).select(*CASE, "gt_tolerance", "strategy", "rank", "cluster_id", "gt_ids", F.when(F.size("gt_ids") > 0, 1).otherwise(0).alias("gt_overlap"))


def _ks(config: AnalysisConfig) -> Column:
    return F.array(*map(F.lit, config.ks))


def _reached(config: AnalysisConfig) -> Column:
    """The cut-offs that a rank lies within."""
    return F.explode(F.filter(_ks(config), lambda k: k >= F.col("rank")))


def with_triage_ranks(top: DataFrame, rows: DataFrame) -> DataFrame:
    """rankings() rows with triage_rank, the place of their clusters in the order of review."""
    few = [*CASE, "cluster_id"]
    ranks = clustering.ranked(rows.select(*few, "file_path", "start_line", "tool_count", "finding_count", "max_severity_rank"), severity_order(), name="triage_rank")
    return top.join(ranks.select(*few, "triage_rank"), few)


def topk(ranked: DataFrame, found: DataFrame) -> DataFrame:
    """The ranked rows with the number and share of the case's items that they and those before them cover."""
    keys = [*CASE, "strategy"]
    first = ranked.select(*keys, "rank", F.explode("gt_ids").alias("gt_id")).groupBy(*keys, "gt_id").agg(F.min("rank").alias("rank")).groupBy(*keys, "rank").agg(F.count("*").alias("_new"))
    rows = ranked.join(first, [*keys, "rank"], "left").join(found.select(*CASE, "has_gt", "gt_total"), CASE)
    so_far = F.sum(F.coalesce("_new", F.lit(0))).over(Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    scored = F.when(F.col("gt_total") > 0, so_far)
    return rows.select(
        *keys, "rank", "cluster_id", "tool_count", F.array_join("tools", ",").alias("tools"), "max_severity", "max_severity_rank", "finding_count", "file_path", "start_line", "triage_rank", "triage_score_v1",
        "gt_overlap", F.array_join("gt_ids", ";").alias("gt_overlap_ids"), F.when(F.col("has_gt") == 1, F.size("gt_ids")).otherwise(0).alias("gt_overlap_ids_count"), "has_gt", "gt_total",
        scored.alias("cumulative_gt_covered"), round6(ratio(scored, F.col("gt_total"))).alias("cumulative_gt_coverage"),
    )


def _totals(ranked: DataFrame, config: AnalysisConfig, keys: list[str]) -> DataFrame:
    """Positives, rows and covered items among the first k of each group; groups without rows are absent."""
    counts = ranked.select(*keys, "gt_overlap", _reached(config).alias("k")).groupBy(*keys, "k").agg(F.count_if(F.col("gt_overlap") == 1).alias("tp"), F.count("*").alias("rows"))
    firsts = ranked.select(*keys, "rank", F.explode("gt_ids").alias("gt_id")).groupBy(*keys, "gt_id").agg(F.min("rank").alias("rank"))
    covered = firsts.select(*keys, _reached(config).alias("k")).groupBy(*keys, "k").agg(F.count("*").alias("covered"))
    return counts.join(covered, [*keys, "k"], "left").na.fill(0, ["covered"])


def by_case(ranked: DataFrame, found: DataFrame, config: AnalysisConfig, strategies: tuple[str, ...] = STRATEGIES, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision and coverage at each k for each case and strategy; null where a case has no ground truth or rows.

    by: columns of both tables that tell more rows of a case apart.  Coverage counts all items of the first k clusters, so it may pass 1.
    """
    keys = [*CASE, *by, "strategy"]
    grid = found.select(*CASE, *by, "n_clusters", "has_gt", "gt_total", F.explode(F.array(*map(F.lit, strategies))).alias("strategy")).select("*", F.explode(_ks(config)).alias("k"))
    rows = grid.join(_totals(ranked, config, keys), [*keys, "k"], "left").na.fill(0, ["tp", "rows", "covered"])
    scored = F.col("has_gt") == 1
    tp, denom, covered = (F.when(scored, F.col(c)).otherwise(0) for c in ("tp", "rows", "covered"))
    return rows.select(
        *keys, "k", "n_clusters", "has_gt", "gt_total", round6(ratio(tp, denom)).alias("precision"), tp.alias("tp_at_k"), denom.alias("denom_at_k"),
        round6(ratio(covered, F.when(scored, F.col("gt_total")))).alias("gt_coverage"), covered.alias("gt_covered_at_k"),
    )


def macro(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Averages over cases of by_case() rows, from unrounded ratios."""
    p, c = ratio(F.col("tp_at_k"), F.col("denom_at_k")), ratio(F.col("gt_covered_at_k"), F.when(F.col("has_gt") == 1, F.col("gt_total")))
    return rows.groupBy("suite_id", *by, "strategy", "k").agg(
        round6(F.avg(p)).alias("precision"), F.count(p).alias("precision_cases"), round6(F.avg(c)).alias("gt_coverage"), F.count(c).alias("gt_coverage_cases")
    )


def macro_from_topk(topk_rows: DataFrame, ks: tuple[int, ...] = (10, 25, 50)) -> DataFrame:
    """Macro precision and coverage from topk() rows alone, for suites whose other tables are lost; NaN where no case counts.

    A case counts for precision with any row, and for coverage with any ground truth; one with fewer than k rows counts all of them.
    """
    keys = ["suite_id", "case_id", "strategy"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))
    reached = F.explode(F.filter(F.array(*map(F.lit, ks)), lambda k: k >= F.col("place")))
    rows = topk_rows.select(*keys, "gt_overlap", "gt_total", "cumulative_gt_covered", place.alias("place"))
    # a cut-off beyond the last row is reached by every row, as k >= place holds for all of them
    each = rows.select("*", reached.alias("k")).groupBy(*keys, "k").agg(
        F.count("*").alias("denom"), F.count_if(F.col("gt_overlap") == 1).alias("tp"), F.max_by(F.coalesce("cumulative_gt_covered", F.lit(0)), "place").alias("covered"), F.min_by(F.coalesce("gt_total", F.lit(0)), "place").alias("total")
    )
    p, c = ratio(F.col("tp"), F.col("denom")), ratio(F.col("covered"), F.col("total"))
    found = each.groupBy("suite_id", "strategy", "k").agg(F.avg(p).alias("precision"), F.avg(c).alias("gt_coverage"))
    grid = topk_rows.select("suite_id").distinct().select("suite_id", F.explode(F.array(*map(F.lit, STRATEGIES))).alias("strategy")).select("*", F.explode(F.array(*map(F.lit, ks))).alias("k"))
    nan = F.lit(float("nan"))
    return grid.join(found, ["suite_id", "strategy", "k"], "left").withColumns({m: F.coalesce(m, nan) for m in ("precision", "gt_coverage")})


def strategy_place(strategy: Column) -> Column:
    """The order of strategies in reports; others come after all of them."""
    known = F.array_position(F.array(*map(F.lit, ("baseline", "agreement", "calibrated"))), strategy)
    return F.when(known > 0, known).otherwise(99)


def micro(rows: DataFrame) -> DataFrame:
    """Ratios of sums over cases."""
    sums = rows.groupBy("suite_id", "strategy", "k").agg(
        F.sum("tp_at_k").alias("tp_at_k"), F.sum("denom_at_k").alias("denom_at_k"), F.sum("gt_covered_at_k").alias("gt_covered_at_k"), F.sum(F.when(F.col("has_gt") == 1, F.col("gt_total")).otherwise(0)).alias("gt_total")
    )
    return sums.withColumns({"precision": round6(ratio(F.col("tp_at_k"), F.col("denom_at_k"))), "gt_coverage": round6(ratio(F.col("gt_covered_at_k"), F.col("gt_total")))})


def _against_baseline(rows: DataFrame, keys: list[str]) -> DataFrame:
    base = rows.where("strategy = 'baseline'").select(*keys, F.col("precision").alias("baseline_precision"), F.col("gt_coverage").alias("baseline_gt_coverage"))
    both = rows.where("strategy <> 'baseline'").join(base, keys)
    return both.withColumns({
        "strategy_precision": F.col("precision"), "strategy_gt_coverage": F.col("gt_coverage"),
        "precision_delta": round6(F.col("precision") - F.col("baseline_precision")), "gt_coverage_delta": round6(F.col("gt_coverage") - F.col("baseline_gt_coverage")),
    })


def deltas_by_case(rows: DataFrame) -> DataFrame:
    """Each strategy minus the baseline, from the rounded values of by_case()."""
    found = _against_baseline(rows, [*CASE, "k"])
    return found.select(*CASE, "strategy", "k", "n_clusters", "has_gt", "gt_total", *[f"{x}_{m}" for m in ("precision", "gt_coverage") for x in ("baseline", "strategy")], "precision_delta", "gt_coverage_delta")


def deltas_of_suite(rows: DataFrame) -> DataFrame:
    """The same for macro() or micro() rows."""
    return _against_baseline(rows, ["suite_id", "k"]).select("suite_id", "strategy", "k", "precision_delta", "gt_coverage_delta")


def topk_focus(macro_rows: DataFrame, micro_rows: DataFrame) -> DataFrame:
    """Precision and coverage of the main strategies at 10, 25 and 50."""
    both = macro_rows.select(F.lit("macro").alias("agg"), "suite_id", "strategy", "k", "precision", "gt_coverage").unionByName(micro_rows.select(F.lit("micro").alias("agg"), "suite_id", "strategy", "k", "precision", "gt_coverage"))
    return both.where(F.col("k").isin(10, 25, 50) & F.col("strategy").isin("baseline", "calibrated_global", "calibrated"))


def _in_gt_cases(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found.where("has_gt = 1").select(*CASE), CASE, "left_semi")


def tool_utility(rows: DataFrame, found: DataFrame) -> DataFrame:
    """For each tool: items it covers, items only it covers, negative clusters it has a part in, and has alone.

    Items are told apart by id across the cases of a suite.
    """
    scored = _in_gt_cases(rows, found)
    pairs = scored.where("gt_overlap = 1").select("suite_id", F.explode("gt_ids").alias("gt_id"), "tools").select("suite_id", "gt_id", F.explode("tools").alias("tool")).distinct()
    alone = pairs.groupBy("suite_id", "gt_id").agg(F.min("tool").alias("tool"), F.max("tool").alias("last")).where("tool = last").groupBy("suite_id", "tool").agg(F.count("*").alias("unique_gt_ids"))
    covers = pairs.groupBy("suite_id", "tool").agg(F.count("*").alias("gt_ids_covered"))
    negatives = scored.where("gt_overlap <> 1").select("suite_id", F.explode("tools").alias("tool"), (F.size("tools") == 1).alias("only"))
    negatives = negatives.groupBy("suite_id", "tool").agg(F.count("*").alias("neg_clusters"), F.count_if("only").alias("exclusive_neg_clusters"))
    out = covers.join(alone, ["suite_id", "tool"], "left").join(negatives, ["suite_id", "tool"], "full_outer")
    return out.na.fill(0).select("suite_id", "tool", "gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters")


MARGINAL = ("baseline", "agreement", "calibrated")


def rankings_without(rows: DataFrame, found: DataFrame, model: DataFrame | None, config: AnalysisConfig) -> DataFrame:
    """rankings() of the clusters in cases with ground truth, with all tools and without each one.

    A cluster without a tool keeps its severity and labels; one that only this tool found goes.  Profiles, not clusters, are
    varied by the tool left out (dropped), '' for none; clusters are ranked that may come first.
    """
    strategies = MARGINAL if model is not None else MARGINAL[:2]
    scored = _in_gt_cases(rows, found).withColumn("_counts", F.array_sort(F.map_entries("tool_counts")))
    kinds = profiles(scored, "_counts")
    variants = kinds.withColumns({f"_of_{c}": F.col(c) for c in ("tools", "tool_count", "finding_count")}).withColumn("dropped", F.explode(F.array(F.lit(""), *map(F.lit, config.tools))))
    counts = F.filter("_counts", lambda x: (x["key"] != F.col("dropped")) & (x["value"] > 0))
    has = F.array_contains("tools", F.col("dropped"))
    less = variants.withColumn("_left", counts).where(~has | (F.size("_left") > 0))
    changed = less.withColumns({
        "tools": F.when(has, F.array_sort(F.transform("_left", lambda x: x["key"]))).otherwise(F.col("tools")),
        "tool_count": F.when(has, F.size("_left")).otherwise(F.col("tool_count")),
        "finding_count": F.when(has, F.aggregate("_left", F.lit(0).cast("bigint"), lambda acc, x: acc + x["value"])).otherwise(F.col("finding_count")),
    }).drop("_left")
    changed = with_score(changed, model, config.calibration, name="_score") if model is not None else changed
    keys = [*CASE, "dropped"]
    ranked = placed(scored, stored(contenders(changed, strategies, keys, max(config.ks))), keys, max(config.ks))
    return ranked.select(*CASE, "dropped", "strategy", "rank", "gt_overlap", "gt_ids")


def tool_marginal(rows: DataFrame, found: DataFrame, utility: DataFrame, ranked: DataFrame, config: AnalysisConfig) -> DataFrame:
    """Precision, coverage and negatives among the first k with all tools and without each one, from rankings_without()."""
    strategies = [s for s in MARGINAL if s != "calibrated" or not ranked.where("strategy = 'calibrated'").isEmpty()]
    scored = _in_gt_cases(rows, found)
    totals = _totals(ranked, config, [*CASE, "dropped", "strategy"]).groupBy("suite_id", "dropped", "strategy", "k").agg(F.sum("tp").alias("tp"), F.sum("rows").alias("rows"), F.sum("covered").alias("covered"))
    items = found.where("has_gt = 1").groupBy("suite_id").agg(F.sum("gt_total").alias("gt_total"))
    metrics = totals.join(items, "suite_id").select(
        "suite_id", "dropped", "strategy", "k", ratio(F.col("tp"), F.col("rows")).alias("precision"), ratio(F.col("covered"), F.col("gt_total")).alias("coverage"), (F.col("rows") - F.col("tp")).alias("neg")
    )
    full, drop = (metrics.select("suite_id", *extra, "strategy", "k", *[F.col(c).alias(f"{c}_{n}") for c in ("precision", "coverage", "neg")]) for n, extra in (("full", ()), ("drop", (F.col("dropped").alias("tool"),))))
    full, drop = full.where(metrics["dropped"] == ""), drop.where("tool <> ''")
    exclusive = F.size("tools") == 1
    parts = scored.select("suite_id", F.explode("tools").alias("tool"), exclusive.alias("only"), "gt_overlap").groupBy("suite_id", "tool").agg(
        F.count("*").alias("clusters_with_tool"), F.count_if("only").alias("clusters_exclusive_total"),
        F.count_if(F.col("only") & (F.col("gt_overlap") == 1)).alias("clusters_exclusive_pos"), F.count_if(F.col("only") & (F.col("gt_overlap") != 1)).alias("clusters_exclusive_neg"),
    )
    grid = utility.select("*", F.explode(F.array(*map(F.lit, strategies))).alias("strategy")).select("*", F.explode(_ks(config)).alias("k"))
    out = grid.join(full, ["suite_id", "strategy", "k"], "left").join(drop, ["suite_id", "tool", "strategy", "k"], "left").join(parts, ["suite_id", "tool"], "left").na.fill(0, ["neg_full", "neg_drop", *parts.columns[2:]])
    return out.select(
        "suite_id", "tool", "strategy", "k", round6("precision_full").alias("precision_full"), round6("precision_drop").alias("precision_drop"), round6(F.col("precision_drop") - F.col("precision_full")).alias("delta_precision"),
        round6("coverage_full").alias("gt_coverage_full"), round6("coverage_drop").alias("gt_coverage_drop"), round6(F.col("coverage_drop") - F.col("coverage_full")).alias("delta_gt_coverage"),
        F.col("neg_full").alias("neg_in_topk_full"), F.col("neg_drop").alias("neg_in_topk_drop"), (F.col("neg_drop") - F.col("neg_full")).alias("delta_neg_in_topk"),
        "gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters", "clusters_with_tool", "clusters_exclusive_total", "clusters_exclusive_pos", "clusters_exclusive_neg",
    )
