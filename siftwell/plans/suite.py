"""A suite's analysis as lazy tables: each property is a plan, built once and shared by those after it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import AnalysisConfig
from siftwell.operators import calibration, clustering, evaluation, filters, groundtruth, report, tolerance, triage
from siftwell.sinks.shared import spread, stored


class Suite:
    """findings: normalised findings of all cases; gt: their ground truth (see groundtruth.normalize_items); declared: the OWASP
    codes that cases declare (see lines.declared_owasp), which count before those in their ids.

    Two passes are explicit: the first queue has no trust model; the model is learned from its features, and the
    calibrated queue uses it.

    Tables that several later ones read (the findings with their normalised paths, the clusters, the model and the rankings)
    are written to the shared folder when they are first asked for, so no plan repeats what stands behind them.  lean: one
    table is asked for and findings are cheap to read again, as from columns of files, so that findings and whole clusters
    are not written; each plan carries the columns that it needs.

    Evaluation, the model and the sweep read near: clusters without their samples, with the items near them.
    """

    def __init__(self, findings: DataFrame, gt: DataFrame, config: AnalysisConfig | None = None, declared: DataFrame | None = None, lean: bool = False):
        self.findings, self.gt, self.config, self.declared = findings, gt, config or AnalysisConfig(), declared
        self._kept = (lambda df: df) if lean else stored

    @cached_property
    def with_path(self) -> DataFrame:
        """The findings with normalised paths, and whether each is in the mode and in scope."""
        return self._kept(filters.flagged(spread(self.findings), self.config))

    @cached_property
    def in_mode(self) -> DataFrame:
        return self.with_path.where("is_in_mode").drop("is_in_mode", "is_in_scope")

    @cached_property
    def items(self) -> DataFrame:
        return self.with_path.where("is_in_mode AND is_in_scope").drop("is_in_mode", "is_in_scope")

    @cached_property
    def assigned(self) -> DataFrame:
        return clustering.assign_clusters(self.items, self.config.tolerance)

    @cached_property
    def clusters(self) -> DataFrame:
        return self._kept(clustering.clusters_of(self.items, self.config.tolerance, self.config.tools))

    @cached_property
    def near(self) -> DataFrame:
        """Clusters without their samples, with the items within reach of any tolerance and evaluation's labels; ids are made anew when it is read."""
        columns = [*clustering.FILE, "start_line", "end_line", "cluster_id", "tools", "tool_count", "finding_count", *[f"{t}_count" for t in self.config.tools], "max_severity", "max_severity_rank"]
        found = groundtruth.with_near(self.clusters.select(*columns), self.gt, max(self.config.gt_tolerance, *self.config.gt_tolerance_candidates))
        return clustering.with_names(stored(evaluation.with_labels(found, self.config, self.declared).drop("cluster_id", "tool_count")))

    @cached_property
    def gt_cases(self) -> DataFrame:
        """The few cases with ground truth, written so that Spark knows how few."""
        return stored(self.gt.select("suite_id", "case_id").distinct())

    @cached_property
    def matches(self) -> DataFrame:
        return groundtruth.match_items(self.gt, self.items, self.config.gt_tolerance)

    def case_rows(self, planned: DataFrame, runs: DataFrame) -> DataFrame:
        """The report's rows of the planned cases (suite_id, case_id); runs: (suite_id, case_id, tool) of the reports that exist."""
        return report.case_rows(planned, runs, self.with_path, self.near, self.matches, self.config.tools)

    @cached_property
    def gaps(self) -> DataFrame:
        return groundtruth.gap_queue(self.matches, self.with_path)

    @cached_property
    def queue(self) -> DataFrame:
        return triage.triage_queue(self.clusters, self.config, declared=self.declared)

    @cached_property
    def features(self) -> DataFrame:
        return triage.triage_features(self.clusters, self.gt, self.config, declared=self.declared)

    @cached_property
    def stored_features(self) -> DataFrame:
        return stored(self.features)

    @cached_property
    def labelled(self) -> DataFrame:
        return calibration.labelled(self.rows, self.gt_cases)

    @cached_property
    def weights(self) -> DataFrame:
        return calibration.global_weights(self.labelled, self.config.calibration)

    @cached_property
    def weights_by_owasp(self) -> DataFrame:
        return calibration.weights_by_owasp(self.labelled, self.config.calibration)

    @cached_property
    def model(self) -> DataFrame:
        return stored(calibration.model(self.labelled, self.config.calibration))

    @cached_property
    def calibrated_queue(self) -> DataFrame:
        return triage.triage_queue(self.clusters, self.config, self.model, self.declared)

    @cached_property
    def rows(self) -> DataFrame:
        return evaluation.rows_of(self.near, self.config)

    @cached_property
    def cases(self) -> DataFrame:
        return stored(evaluation.cases(self.rows, self.gt))

    @cached_property
    def ranked(self) -> DataFrame:
        return stored(evaluation.rankings(self.rows, self.model, self.config, max(self.config.ks)))

    @cached_property
    def topk(self) -> DataFrame:
        return evaluation.topk(evaluation.with_triage_ranks(self.ranked, self.rows), self.cases)

    @cached_property
    def macro_from_topk(self) -> DataFrame:
        unranked = self.ranked.withColumn("triage_rank", F.lit(None).cast("int"))  # a column that these metrics don't read
        return evaluation.macro_from_topk(evaluation.topk(unranked, self.cases))

    @cached_property
    def by_case(self) -> DataFrame:
        return evaluation.by_case(self.ranked, self.cases, self.config)

    @cached_property
    def macro(self) -> DataFrame:
        return evaluation.macro(self.by_case)

    @cached_property
    def micro(self) -> DataFrame:
        return evaluation.micro(self.by_case)

    @cached_property
    def utility(self) -> DataFrame:
        return evaluation.tool_utility(self.rows, self.cases)

    @cached_property
    def marginal(self) -> DataFrame:
        ranked = stored(evaluation.rankings_without(self.rows, self.cases, self.model, self.config))
        return evaluation.tool_marginal(self.rows, self.cases, self.utility, ranked, self.config)

    @cached_property
    def swept(self) -> DataFrame:
        """The clusters with what each candidate tolerance reaches."""
        return tolerance.labels(self.near, self.config.gt_tolerance_candidates)

    @cached_property
    def tolerance_tools(self) -> DataFrame:
        """The weights of each tool at each candidate tolerance."""
        return tolerance.tools_at(self.swept, self.gt_cases, self.config)

    @cached_property
    def tolerance_macro(self) -> DataFrame:
        """Macro precision and coverage of each strategy and k at each candidate tolerance."""
        return tolerance.macro_at(self.swept, self.gt, stored(tolerance.models_at(self.swept, self.gt_cases, self.config)), self.config)

    @cached_property
    def tolerance_report(self) -> DataFrame:
        """Overlaps, ambiguities and macro metrics in one row per tolerance."""
        return tolerance.sweep_report(tolerance.stats_at(self.swept, self.config.gt_tolerance_candidates), self.tolerance_macro)
