"""DuckDB SQL for the registered queries, written independently of the DataFrame plans.

VIEWS holds common table expressions; a query names what it selects from, and sql() puts the views it needs before it.
"""

from __future__ import annotations

import re

from siftwell.sources.adapters import CASES, CWE_OWASP, CWE_OWASP_2017, FINDINGS, FLAWED, GROUND_TRUTH, GT_CASES, NAMED_RULES, RAW_PATHS, RECEIPTS, RULES, SEVERITIES, SUITES, TAGGED, TOOL_RUNS

TOOLS = ("semgrep", "snyk", "sonar", "aikido")
KS = "(1), (3), (5), (10), (25), (50)"
C = "suite_id, case_id"
_BLANK = "coalesce({0}, '')"
_RANK = "CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END"
_SEQ = "item_seq, coalesce(tool, ''), coalesce(rule_id, ''), coalesce(title, ''), coalesce(finding_id, ''), coalesce(severity, '')"
_SEV_ORDER = "max_severity_rank DESC, tool_count DESC, finding_count DESC, file_path, coalesce(start_line, 0), cluster_id"
_AGR_ORDER = "tool_count DESC, max_severity_rank DESC, finding_count DESC, file_path, coalesce(start_line, 0), cluster_id"
_BONUS = "CASE max_severity WHEN 'HIGH' THEN 0.25::DOUBLE WHEN 'MEDIUM' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END"


def _adapted(text: str, suite: str = "suite_main") -> str:
    return text.replace("{suite}", suite).replace("{kept}", SUITES[suite]).replace("{lineitem}", "lineitem").replace("{part}", "part").replace("{day}", "strftime(l_shipdate, '%Y%m%d')")


def _score(weights: str) -> str:
    total = f"list_reduce([0.0::DOUBLE] || list_transform(tools, lambda t: coalesce({weights}[t], 0.0::DOUBLE)), lambda a, b: a + b)"
    return f"round_even({total} + 0.5::DOUBLE * greatest(tool_count - 1, 0) + {_BONUS}, 6)"


def _weights(keys: str) -> str:
    return f"""SELECT {keys}, tool, tp, fp, round_even(p, 6) AS p_smoothed, round_even(ln(greatest(0.01, least(0.99, p)) / (1 - greatest(0.01, least(0.99, p)))), 6) AS weight
  FROM (SELECT *, (tp + 1.0::DOUBLE) / (tp + fp + 2.0::DOUBLE) AS p FROM (
    SELECT {keys}, tool, count(*) FILTER (gt_overlap = 1) AS tp, count(*) FILTER (gt_overlap <> 1) AS fp FROM (SELECT *, unnest(tools) AS tool FROM lab) GROUP BY {keys}, tool))"""


def _topk(source: str, name: str, order: str, score: str = "NULL::DOUBLE", keys: str = C) -> str:
    return f"SELECT {keys}, '{name}' AS strategy, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS INT) AS rank, * EXCLUDE ({keys}), {score} AS triage_score_v1 FROM {source} QUALIFY rank <= 50"


def _totals(source: str, keys: str) -> str:
    return f"""SELECT {keys}, k, count(*) FILTER (gt_overlap = 1) AS tp, count(*) AS n,
    len(list_distinct(flatten(list(gt_ids)))) AS covered FROM {source} JOIN (VALUES {KS}) AS ks(k) ON rank <= k GROUP BY {keys}, k"""


VIEWS = {
    "f": _adapted(FINDINGS),
    "f_prev": _adapted(FINDINGS, "suite_prev"),
    "gt": _adapted(GROUND_TRUTH),
    "gt_prev": _adapted(GROUND_TRUTH, "suite_prev"),
    "paths": _adapted(RAW_PATHS),
    "runs": _adapted(TOOL_RUNS),
    "sec": "SELECT * FROM f WHERE (tool = 'sonar' AND issue_type = 'VULNERABILITY') OR (tool = 'semgrep' AND issue_type = 'SECURITY') OR tool IN ('snyk', 'aikido')",
    "items": "SELECT * FROM sec WHERE file_path NOT LIKE 'benchmark/%'",
    "swept": f"""SELECT *, max(end_line_number) OVER (PARTITION BY {C}, file_path ORDER BY line_number, {_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM items WHERE line_number > 0""",
    "islands": f"""SELECT *, sum(CASE WHEN reach IS NULL OR line_number > reach + 3 THEN 1 ELSE 0 END) OVER (PARTITION BY {C}, file_path ORDER BY line_number, {_SEQ} ROWS UNBOUNDED PRECEDING) AS island FROM swept""",
    "asg": f"""SELECT * EXCLUDE (reach, island), min(line_number) OVER w AS start_line, max(end_line_number) OVER w AS end_line FROM islands WINDOW w AS (PARTITION BY {C}, file_path, island)
  UNION ALL SELECT *, NULL, NULL FROM items WHERE coalesce(line_number, 0) <= 0""",
    "named": "SELECT *, file_path || ':' || coalesce(start_line || '-' || end_line, 'unknown') AS cluster_id FROM asg",
    "best": f"SELECT {C}, cluster_id, severity AS max_severity FROM named WHERE {_RANK} > 0 QUALIFY row_number() OVER (PARTITION BY {C}, cluster_id ORDER BY {_RANK} DESC, item_seq) = 1",
    "sample": f"""SELECT {C}, cluster_id, tool AS sample_tool, coalesce(rule_id, '') AS sample_rule_id, coalesce(title, '') AS sample_title, coalesce(severity, '') AS sample_severity FROM named
  QUALIFY row_number() OVER (PARTITION BY {C}, cluster_id ORDER BY {_RANK} DESC, tool, coalesce(rule_id, ''), coalesce(title, ''), coalesce(finding_id, ''), item_seq, coalesce(severity, '')) = 1""",
    "firsts": f"SELECT {C}, cluster_id, rule_id AS first_rule_id, title AS first_title FROM named QUALIFY row_number() OVER (PARTITION BY {C}, cluster_id ORDER BY {_SEQ}) = 1",
    "cl": f"""SELECT {C}, file_path, cluster_id, start_line, end_line, list_sort(list(DISTINCT tool)) AS tools, CAST(count(DISTINCT tool) AS INT) AS tool_count, count(*) AS finding_count,
    max({_RANK}) AS max_severity_rank, coalesce(any_value(max_severity), '') AS max_severity, count(DISTINCT rule_id) AS unique_rule_count, count(DISTINCT title) AS unique_title_count,
    count(DISTINCT finding_id) AS unique_finding_id_count, {", ".join(f"count(*) FILTER (tool = '{t}') AS {t}_count" for t in TOOLS)},
    {", ".join(f"count(*) FILTER (coalesce(severity, 'UNKNOWN') = '{s}') AS severity_{s.lower()}_count" for s in ("HIGH", "MEDIUM", "LOW", "UNKNOWN"))},
    any_value(sample_tool) AS sample_tool, any_value(sample_rule_id) AS sample_rule_id, any_value(sample_title) AS sample_title, any_value(sample_severity) AS sample_severity,
    any_value(first_rule_id) AS first_rule_id, any_value(first_title) AS first_title
  FROM named LEFT JOIN best USING ({C}, cluster_id) JOIN sample USING ({C}, cluster_id) JOIN firsts USING ({C}, cluster_id) GROUP BY {C}, file_path, cluster_id, start_line, end_line""",
    "spots": f"SELECT DISTINCT {C}, file_path AS file, tool, coalesce(line_number, 0) AS line FROM items",
    "hits": f"SELECT {C}, gt_id, list_sort(list(DISTINCT tool)) AS found FROM gt JOIN spots USING ({C}, file) WHERE line BETWEEN start_line AND end_line GROUP BY {C}, gt_id",
    "matches": f"""SELECT {C}, gt_id, track, set_name, file, start_line, end_line, found IS NOT NULL AS matched, CAST(coalesce(len(found), 0) AS INT) AS matched_tool_count,
    coalesce(array_to_string(found, ','), '') AS matched_tools FROM gt LEFT JOIN hits USING ({C}, gt_id)""",
    "gaps": """SELECT m.*, CASE WHEN any_f IS NULL THEN 'no_findings' WHEN any_i IS NULL THEN 'filtered_out' ELSE 'found_but_not_matched' END AS reason,
    CASE WHEN any_f IS NULL OR any_i IS NOT NULL THEN '' WHEN any_s IS NULL THEN 'mode' ELSE 'scope' END AS filtered_by
  FROM matches m LEFT JOIN (SELECT DISTINCT case_id, file_path AS file, 1 AS any_f FROM f) USING (case_id, file) LEFT JOIN (SELECT DISTINCT case_id, file_path AS file, 1 AS any_i FROM items) USING (case_id, file)
  LEFT JOIN (SELECT DISTINCT case_id, file_path AS file, 1 AS any_s FROM sec) USING (case_id, file) WHERE NOT matched""",
    "queue": f"SELECT *, CAST(row_number() OVER (PARTITION BY {C} ORDER BY {_SEV_ORDER}) AS INT) AS rank FROM cl",
    "pairs": f"""SELECT {C}, cluster_id, gt_id, set_name, track, t AS gt_tolerance FROM cl JOIN gt ON cl.suite_id = gt.suite_id AND cl.case_id = gt.case_id AND cl.file_path = gt.file,
    (VALUES (0), (1), (2), (3), (5), (10)) AS tols(t) WHERE coalesce(cl.start_line, 0) <= gt.end_line + t AND coalesce(cl.end_line, 0) >= gt.start_line - t""".replace(f"SELECT {C}", "SELECT cl.suite_id, cl.case_id"),
    "labels0": f"SELECT {C}, cluster_id, list_sort(list(DISTINCT gt_id)) AS gt_ids, list_sort(list(DISTINCT set_name)) AS gt_sets, list_sort(list(DISTINCT track)) AS gt_tracks FROM pairs WHERE gt_tolerance = 0 GROUP BY {C}, cluster_id",
    "feat": f"""SELECT queue.*, upper(substr(case_id, 11, 3)) AS owasp_id, coalesce(gt_ids, []) AS gt_ids, coalesce(gt_sets, []) AS gt_sets, coalesce(gt_tracks, []) AS gt_tracks, CASE WHEN gt_ids IS NULL THEN 0 ELSE 1 END AS gt_overlap
  FROM queue LEFT JOIN labels0 USING ({C}, cluster_id)""",
    "lab": f"SELECT * FROM feat WHERE case_id IN (SELECT case_id FROM gt)",
    "w_all": _weights("suite_id"),
    "support": "SELECT suite_id, owasp_id, count(*) AS support_clusters, count(DISTINCT case_id) AS support_cases, CAST(sum(gt_overlap) AS BIGINT) AS gt_positive_clusters FROM lab GROUP BY suite_id, owasp_id",
    "w_own": f"SELECT *, 10 AS min_support_by_owasp, CASE WHEN support_clusters < 10 THEN 1 ELSE 0 END AS fallback_to_global FROM ({_weights('suite_id, owasp_id')}) JOIN support USING (suite_id, owasp_id)",
    "m_all": "SELECT suite_id, map(list(tool), list(weight)) AS w FROM w_all GROUP BY suite_id",
    "m_own": "SELECT suite_id, owasp_id, map(list(tool), list(weight)) AS own FROM w_own WHERE fallback_to_global = 0 GROUP BY suite_id, owasp_id",
    "scored": f"SELECT * EXCLUDE (w, own), {_score('coalesce(own, w)')} AS s_own, {_score('w')} AS s_all FROM feat JOIN m_all USING (suite_id) LEFT JOIN m_own USING (suite_id, owasp_id)",
    "ranked": " UNION ALL ".join(
        f"SELECT * FROM ({_topk('(SELECT * EXCLUDE (rank), rank AS triage_rank FROM scored)', n, o, s)})"
        for n, o, s in (("baseline", _SEV_ORDER, "NULL::DOUBLE"), ("agreement", _AGR_ORDER, "NULL::DOUBLE"), ("calibrated_global", f"s_all DESC, {_SEV_ORDER}", "s_all"), ("calibrated", f"s_own DESC, {_SEV_ORDER}", "s_own"))
    ),
    "cases": f"""SELECT {C}, coalesce(n_clusters, 0) AS n_clusters, coalesce(positives, 0) AS positives, coalesce(gt_total, 0) AS gt_total, CASE WHEN gt_total > 0 THEN 1 ELSE 0 END AS has_gt
  FROM (SELECT {C}, count(*) AS n_clusters, count(*) FILTER (gt_overlap = 1) AS positives FROM feat GROUP BY {C}) FULL JOIN (SELECT {C}, count(DISTINCT gt_id) AS gt_total FROM gt GROUP BY {C}) USING ({C})""",
    "totals": _totals("ranked", f"{C}, strategy"),
    "by_case": f"""SELECT {C}, strategy, k, n_clusters, has_gt, gt_total, round_even(CASE WHEN has_gt = 1 AND n > 0 THEN CAST(tp AS DOUBLE) / n END, 6) AS precision, CASE WHEN has_gt = 1 THEN coalesce(tp, 0) ELSE 0 END AS tp_at_k,
    CASE WHEN has_gt = 1 THEN coalesce(n, 0) ELSE 0 END AS denom_at_k, round_even(CASE WHEN has_gt = 1 THEN CAST(coalesce(covered, 0) AS DOUBLE) / gt_total END, 6) AS gt_coverage, CASE WHEN has_gt = 1 THEN coalesce(covered, 0) ELSE 0 END AS gt_covered_at_k
  FROM cases CROSS JOIN (VALUES ('baseline'), ('agreement'), ('calibrated_global'), ('calibrated')) AS st(strategy) CROSS JOIN (VALUES {KS}) AS ks(k) LEFT JOIN totals USING ({C}, strategy, k)""",
    "macro": """SELECT suite_id, strategy, k, round_even(avg(CASE WHEN denom_at_k > 0 THEN CAST(tp_at_k AS DOUBLE) / denom_at_k END), 6) AS precision, count(*) FILTER (denom_at_k > 0) AS precision_cases,
    round_even(avg(CASE WHEN has_gt = 1 THEN CAST(gt_covered_at_k AS DOUBLE) / gt_total END), 6) AS gt_coverage, count(*) FILTER (has_gt = 1) AS gt_coverage_cases FROM by_case GROUP BY suite_id, strategy, k""",
    "micro": """SELECT *, round_even(CASE WHEN denom_at_k > 0 THEN CAST(tp_at_k AS DOUBLE) / denom_at_k END, 6) AS precision, round_even(CASE WHEN gt_total > 0 THEN CAST(gt_covered_at_k AS DOUBLE) / gt_total END, 6) AS gt_coverage
  FROM (SELECT suite_id, strategy, k, CAST(sum(tp_at_k) AS BIGINT) AS tp_at_k, CAST(sum(denom_at_k) AS BIGINT) AS denom_at_k, CAST(sum(gt_covered_at_k) AS BIGINT) AS gt_covered_at_k, CAST(sum(gt_total) FILTER (has_gt = 1) AS BIGINT) AS gt_total FROM by_case GROUP BY suite_id, strategy, k)""",
    "inside": "SELECT feat.* FROM feat JOIN cases USING (suite_id, case_id) WHERE has_gt = 1",
    "covers": "SELECT suite_id, gt_id, list_sort(list(DISTINCT tool)) AS by_tools FROM (SELECT suite_id, gt_id, unnest(tools) AS tool FROM (SELECT suite_id, tools, unnest(gt_ids) AS gt_id FROM inside)) GROUP BY suite_id, gt_id",
    "utility": """SELECT suite_id, tool, coalesce(gt_ids_covered, 0) AS gt_ids_covered, coalesce(unique_gt_ids, 0) AS unique_gt_ids, coalesce(neg_clusters, 0) AS neg_clusters, coalesce(exclusive_neg_clusters, 0) AS exclusive_neg_clusters
  FROM (SELECT suite_id, tool, count(*) AS gt_ids_covered, count(*) FILTER (len(by_tools) = 1) AS unique_gt_ids FROM (SELECT *, unnest(by_tools) AS tool FROM covers) GROUP BY suite_id, tool)
  FULL JOIN (SELECT suite_id, tool, count(*) AS neg_clusters, count(*) FILTER (tool_count = 1) AS exclusive_neg_clusters FROM (SELECT *, unnest(tools) AS tool FROM inside WHERE gt_overlap = 0) GROUP BY suite_id, tool) USING (suite_id, tool)""",
    "dropped": f"""SELECT * REPLACE (list_filter(tools, lambda t: t <> gone) AS tools, CAST(len(list_filter(tools, lambda t: t <> gone)) AS INT) AS tool_count,
      finding_count - CASE gone {" ".join(f"WHEN '{t}' THEN {t}_count" for t in TOOLS)} ELSE 0 END AS finding_count)
  FROM inside, (VALUES (''), {", ".join(f"('{t}')" for t in TOOLS)}) AS d(gone) WHERE tools <> [gone]""",
    "rescored": f"SELECT * EXCLUDE (w, own), {_score('coalesce(own, w)')} AS s_own FROM dropped JOIN m_all USING (suite_id) LEFT JOIN m_own USING (suite_id, owasp_id)",
    "reranked": " UNION ALL ".join(
        f"SELECT * FROM ({_topk('(SELECT * EXCLUDE (rank) FROM rescored)', n, o, keys=C + ', gone')})" for n, o in (("baseline", _SEV_ORDER), ("agreement", _AGR_ORDER), ("calibrated", f"s_own DESC, {_SEV_ORDER}"))
    ),
    "retotals": f"SELECT suite_id, gone, strategy, k, sum(tp) AS tp, sum(n) AS n, sum(covered) AS covered FROM ({_totals('reranked', C + ', gone, strategy')}) GROUP BY suite_id, gone, strategy, k",
    "metrics": "SELECT suite_id, gone, strategy, k, CAST(tp AS DOUBLE) / n AS p, CAST(covered AS DOUBLE) / total AS c, CAST(n - tp AS BIGINT) AS neg FROM retotals JOIN (SELECT suite_id, sum(gt_total) AS total FROM cases GROUP BY suite_id) USING (suite_id)",
    "parts": """SELECT suite_id, tool, count(*) AS clusters_with_tool, count(*) FILTER (tool_count = 1) AS clusters_exclusive_total, count(*) FILTER (tool_count = 1 AND gt_overlap = 1) AS clusters_exclusive_pos,
    count(*) FILTER (tool_count = 1 AND gt_overlap = 0) AS clusters_exclusive_neg FROM (SELECT *, unnest(tools) AS tool FROM inside) GROUP BY suite_id, tool""",
    "marginal": """SELECT suite_id, tool, a.strategy, a.k, round_even(a.p, 6) AS precision_full, round_even(b.p, 6) AS precision_drop, round_even(b.p - a.p, 6) AS delta_precision, round_even(a.c, 6) AS gt_coverage_full,
    round_even(b.c, 6) AS gt_coverage_drop, round_even(b.c - a.c, 6) AS delta_gt_coverage, a.neg AS neg_in_topk_full, coalesce(b.neg, 0) AS neg_in_topk_drop, coalesce(b.neg, 0) - a.neg AS delta_neg_in_topk,
    gt_ids_covered, unique_gt_ids, neg_clusters, exclusive_neg_clusters, clusters_with_tool, clusters_exclusive_total, clusters_exclusive_pos, clusters_exclusive_neg
  FROM utility JOIN (SELECT * FROM metrics WHERE gone = '') a USING (suite_id) LEFT JOIN metrics b ON b.suite_id = utility.suite_id AND b.gone = tool AND b.strategy = a.strategy AND b.k = a.k JOIN parts USING (suite_id, tool)""".replace("SELECT suite_id, tool, a.", "SELECT utility.suite_id, utility.tool, a."),
    "sweep": """SELECT suite_id, t AS gt_tolerance, clusters_total, coalesce(pos, 0) AS gt_overlap_1, clusters_total - coalesce(pos, 0) AS gt_overlap_0, round_even(CAST(coalesce(pos, 0) AS DOUBLE) / clusters_total, 6) AS gt_overlap_rate,
    coalesce(ids, 0) AS gt_ids_covered, coalesce(multi, 0) AS clusters_multi_gt, coalesce(spread, 0) AS gt_ids_multi_cluster, coalesce(most_clusters, 0) AS max_clusters_per_gt_id, coalesce(most_ids, 0) AS max_gt_ids_per_cluster
  FROM (SELECT suite_id, count(*) AS clusters_total FROM cl GROUP BY suite_id) CROSS JOIN (VALUES (0), (1), (2), (3), (5), (10)) AS tols(t)
  LEFT JOIN (SELECT suite_id, gt_tolerance AS t, count(*) AS pos, count(*) FILTER (n > 1) AS multi, max(n) AS most_ids FROM (SELECT suite_id, gt_tolerance, case_id, cluster_id, count(DISTINCT gt_id) AS n FROM pairs GROUP BY ALL) GROUP BY ALL) USING (suite_id, t)
  LEFT JOIN (SELECT suite_id, gt_tolerance AS t, count(*) AS ids, count(*) FILTER (n > 1) AS spread, max(n) AS most_clusters FROM (SELECT suite_id, gt_tolerance, gt_id, count(*) AS n FROM pairs GROUP BY ALL) GROUP BY ALL) USING (suite_id, t)""",
    "peaks": "SELECT suite_id, most, CAST(ceil(CAST(most AS DOUBLE) * 0.95::DOUBLE - 1e-9::DOUBLE) AS BIGINT) AS needed FROM (SELECT suite_id, max(gt_overlap_1) AS most FROM sweep GROUP BY suite_id)",
    "counts": "SELECT suite_id, count(*) AS clusters_total, count(*) FILTER (gt_overlap = 1) AS clusters_gt_pos, count(*) FILTER (gt_overlap <> 1) AS clusters_gt_neg, count(DISTINCT case_id) AS cases_seen FROM feat GROUP BY suite_id",
    "cwe_map": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v})" for k, v in CWE_OWASP.items()) + ") AS t(cwe, codes)",
}


def _needed(text: str, views: dict[str, str], seen: dict[str, None]) -> None:
    for name in re.findall(r"\b\w+\b", text):
        if name in views and name not in seen and re.search(rf"(FROM|JOIN|,) \(*{name}\b", text):
            _needed(views[name], views, seen)
            seen[name] = None


def sql(select: str, views: dict[str, str] = VIEWS) -> str:
    """The query after the views that it needs, in order."""
    seen: dict[str, None] = {}
    _needed(select, views, seen)
    return ("WITH " + ", ".join(f"{n} AS (\n  {views[n].strip()}\n)" for n in seen) + "\n" if seen else "") + select


_QUEUE = f"{C}, rank, {{score}}file_path, start_line, end_line, tool_count, array_to_string(tools, ',') AS tools, finding_count AS total_findings, max_severity, sample_rule_id, sample_title, cluster_id"
_LISTS = ", ".join(f"to_json({c})::VARCHAR AS gt_overlap_{n}_json, array_to_string({c}, ';') AS gt_overlap_{n}" for n, c in (("ids", "gt_ids"), ("sets", "gt_sets"), ("tracks", "gt_tracks")))
_TITLES = " ".join(f"WHEN 'A{k:02d}' THEN '{t}'" for k, t in enumerate(
    ["Broken Access Control", "Cryptographic Failures", "Injection", "Insecure Design", "Security Misconfiguration", "Vulnerable and Outdated Components", "Identification and Authentication Failures",
     "Software and Data Integrity Failures", "Security Logging and Monitoring Failures", "Server-Side Request Forgery"], 1))
_MATRIX = f"file_path, start_line, end_line, cluster_id, array_to_string(tools, ',') AS tools, tool_count, finding_count AS total_findings, max_severity, {', '.join(f'{t}_count' for t in TOOLS)}"
_COUNTS_JSON = "'{' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN {t}_count > 0 THEN '\"{t}\":' || {t}_count END" for t in sorted(TOOLS)) + "], lambda x: x IS NOT NULL), ',') || '}'"


def _summary(*by: str) -> str:
    keys = ", ".join([C, *by])
    return f"SELECT {keys}, count(*) AS gt_items, count(*) FILTER (matched) AS gt_matched, round_even(CAST(count(*) FILTER (matched) AS DOUBLE) / count(*), 6) AS match_rate FROM matches GROUP BY {keys}"


def _against(table: str, keys: str, more: str) -> str:
    return f"""SELECT {', '.join(f'c.{k}' for k in keys.split(', '))}, c.strategy, c.k, {more}round_even(c.precision - b.precision, 6) AS precision_delta, round_even(c.gt_coverage - b.gt_coverage, 6) AS gt_coverage_delta
    FROM {table} c JOIN {table} b USING ({keys}, k) WHERE c.strategy <> 'baseline' AND b.strategy = 'baseline'"""


def _unpivot(source: str, section: str, names: list[str], tool: str = "''", strategy: str = "''", k: str = "NULL::INT", suffix: str = "''") -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{n}' || {suffix} AS name, {tool} AS tool, {strategy} AS strategy, {k} AS k, CAST({n} AS DOUBLE) AS value FROM {source}" for n in names)


_UTILITY = ["gt_ids_covered", "unique_gt_ids", "neg_clusters", "exclusive_neg_clusters"]
_MARGINAL = ["precision_full", "precision_drop", "delta_precision", "gt_coverage_full", "gt_coverage_drop", "delta_gt_coverage", "neg_in_topk_full", "neg_in_topk_drop", "delta_neg_in_topk", *_UTILITY,
             "clusters_with_tool", "clusters_exclusive_total", "clusters_exclusive_pos", "clusters_exclusive_neg"]


def _long_table() -> str:
    return " UNION ALL ".join([
        _unpivot("counts", "dataset", ["clusters_total", "clusters_gt_pos", "clusters_gt_neg", "cases_seen"]),
        _unpivot("micro", "eval_micro", ["precision", "gt_coverage"], strategy="strategy", k="k"),
        _unpivot("macro", "eval_macro", ["precision", "gt_coverage"], strategy="strategy", k="k"),
        _unpivot("w_all", "calibration_weight_global", ["weight"], tool="tool"),
        _unpivot("w_own", "calibration_weight_by_owasp", ["weight"], tool="tool", suffix="':' || owasp_id"),
        _unpivot("utility", "tool_utility", _UTILITY, tool="tool"),
    ])


def _compare() -> str:
    """Both runs' views under names of their own."""
    def renamed(text: str) -> str:
        return re.sub(r"\b(" + "|".join(sorted((n for n in VIEWS if n not in ("f", "gt", "f_prev", "gt_prev")), key=len, reverse=True)) + r")\b(?=[\s);,.]|$)(?<!_at)", lambda m: f"p_{m[1]}", text)

    prev = {}
    for name, text in VIEWS.items():
        if name not in ("f", "gt", "f_prev", "gt_prev", "paths", "runs", "cwe_map"):
            prev[name] = re.sub(r"(FROM|JOIN) (\(*)(\w+)\b", lambda m: f"{m[1]} {m[2]}p_{m[3]}" if m[3] in VIEWS else m[0], text)
            prev[name] = re.sub(r"\b(cl|gt|queue|feat|utility|cases)\.", r"p_\1.", prev[name])
    views = dict(VIEWS) | {f"p_{n}": t for n, t in prev.items()} | {"p_f": VIEWS["f_prev"], "p_gt": VIEWS["gt_prev"]}
    old = re.sub(r"FROM (\w+)", r"FROM p_\1", _long_table())
    views |= {"new_run": _long_table(), "old_run": old}
    select = """SELECT coalesce(a.section, b.section) AS section, coalesce(a.name, b.name) AS name, coalesce(a.tool, b.tool) AS tool, coalesce(a.strategy, b.strategy) AS strategy, coalesce(a.k, b.k) AS k,
    a.value AS a, b.value AS b, b.value - a.value AS delta FROM old_run a FULL JOIN new_run b ON a.section = b.section AND a.name = b.name AND a.tool = b.tool AND a.strategy = b.strategy AND a.k IS NOT DISTINCT FROM b.k"""
    return sql(select, views)


_NOT_RUN = "regexp_full_match(run_id, '[0-9]{10}([0-9]{6})?')"
_MAP = "CASE upper({0}) {1} ELSE {2} END"

SELECTS = {
    "normalize_paths": r"""SELECT case_id, tool, l_orderkey, l_linenumber, raw_path, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(raw_path, chr(92), '/'), '^.:', ''), '^.*/repo/', '', 'i'), '^/+', ''), '^\./', ''), '/+', '/', 'g') AS file_path,
    regexp_replace(regexp_replace(regexp_replace(replace(raw_path, chr(92), '/'), '^(\./)+', ''), '^/+|/+$', '', 'g'), '/+', '/', 'g') AS as_prefix FROM paths""",
    "location_keys": "SELECT file_path || ':' || coalesce(line_number, 0) || '-' || coalesce(end_line_number, line_number, 0) AS location_key, count(*) AS findings FROM f GROUP BY ALL",
    "latest_run": f"SELECT case_id, tool, max(run_id) AS run_id FROM runs WHERE {_NOT_RUN} GROUP BY ALL",
    "severity_maps": """SELECT DISTINCT word, raw, CASE word WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS rank, CASE word WHEN 'URGENT' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS report_rank,
    CASE WHEN raw IN ('error', 'critical', 'high') THEN 'HIGH' WHEN raw IN ('info', 'low') THEN 'LOW' ELSE 'MEDIUM' END AS semgrep, CASE word WHEN 'URGENT' THEN 'HIGH' WHEN '' THEN NULL ELSE 'MEDIUM' END AS sarif, CASE word WHEN 'HIGH' THEN 'HIGH' END AS sonar,
    label AS generic, CASE WHEN raw = 'very high risk' THEN 'HIGH' ELSE label END AS aikido FROM (SELECT *, CASE WHEN lower(raw) IN ('critical', 'crit', 'blocker', 'major', 'high', 'error', '7.5') THEN 'HIGH' WHEN raw IN ('medium', 'moderate', 'warning', 'warn', 'minor', '4') THEN 'MEDIUM'
    WHEN raw IN ('low', 'info', 'informational', 'note', 'none', '.5') THEN 'LOW' END AS label FROM (SELECT regexp_extract(o_orderpriority, '[A-Z]+') AS word, (""" + str(list(SEVERITIES)) + """)[o_custkey % """ + str(len(SEVERITIES)) + """ + 1] AS raw FROM orders))""",
    "cwe_ids": "SELECT cwe_id, CASE WHEN cwe_id IS NOT NULL THEN 'CWE-' || regexp_extract(cwe_id, '[0-9]+') END AS cwe, count(*) AS findings FROM f GROUP BY ALL",
    "filter_mode": f"SELECT {C}, tool, issue_type, count(*) AS findings FROM sec GROUP BY ALL",
    "filter_scope": f"SELECT {C}, file_path, count(*) AS findings FROM items GROUP BY ALL",
    "filter_counts": f"""SELECT {C}, tool, count(*) AS loaded, count(*) FILTER (bad) AS removed_mode, count(*) FILTER (NOT bad AND far) AS removed_scope, count(*) FILTER (NOT bad AND NOT far) AS kept
    FROM (SELECT *, issue_type IN ('CODE_SMELL', 'CORRECTNESS') AS bad, file_path LIKE 'benchmark/%' AS far FROM f) GROUP BY ALL""",
    "severity_totals": f"SELECT {C}, tool, count(*) AS findings, count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'MEDIUM') AS medium, count(*) FILTER (severity = 'LOW') AS low, count(*) FILTER (severity IS NULL) AS other FROM items GROUP BY ALL",
    "cluster_locations": f"SELECT {C}, file_path, cluster_id, start_line, end_line, array_to_string(tools, ',') AS tools, tool_count, finding_count, max_severity FROM cl",
    "location_matrix": f"SELECT {C}, {_MATRIX} FROM cl",
    "hotspot_matrix": f"SELECT {C}, CAST(row_number() OVER (PARTITION BY {C} ORDER BY {_AGR_ORDER}) AS INT) AS place, {_MATRIX} FROM cl",
    "overview_files": f"""SELECT {C}, file_path, string_agg(tool, ',' ORDER BY tool) AS tools, CAST(count(*) AS INT) AS tool_count, string_agg(tool || ':' || n, ',' ORDER BY tool) AS finding_counts
    FROM (SELECT {C}, file_path, tool, count(*) AS n FROM items GROUP BY ALL) GROUP BY {C}, file_path""",
    "overview_tools": f"""SELECT {C}, tool, findings, coalesce(files, 0) AS files, coalesce(unique_files, 0) AS unique_files FROM (SELECT {C}, tool, count(*) AS findings FROM sec GROUP BY ALL)
    LEFT JOIN (SELECT {C}, tool, count(DISTINCT file_path) AS files FROM items GROUP BY ALL) USING ({C}, tool)
    LEFT JOIN (SELECT {C}, tool, count(*) AS unique_files FROM (SELECT {C}, file_path, min(tool) AS tool FROM items GROUP BY {C}, file_path HAVING count(DISTINCT tool) = 1) GROUP BY ALL) USING ({C}, tool)""",
    "unique_files": f"SELECT {C}, min(tool) AS tool, file_path FROM items GROUP BY {C}, file_path HAVING count(DISTINCT tool) = 1",
    "tool_profile": f"""SELECT {C}, tool, coalesce(findings, 0) AS findings, coalesce(files, 0) AS files, coalesce(high, 0) AS high, coalesce(medium, 0) AS medium, coalesce(low, 0) AS low, coalesce(unknown, 0) AS unknown, coalesce(types, '') AS types
    FROM (SELECT DISTINCT {C} FROM items) CROSS JOIN (VALUES ('semgrep'), ('snyk'), ('sonar'), ('aikido')) AS ts(tool)
    LEFT JOIN (SELECT {C}, tool, count(*) AS findings, count(DISTINCT file_path) AS files, count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'MEDIUM') AS medium, count(*) FILTER (severity = 'LOW') AS low, count(*) FILTER (severity IS NULL) AS unknown FROM items GROUP BY ALL) USING ({C}, tool)
    LEFT JOIN (SELECT {C}, tool, string_agg(issue_type || ':' || n, ',' ORDER BY n DESC, first, issue_type) AS types FROM (SELECT {C}, tool, issue_type, count(*) AS n, min(item_seq) AS first FROM items GROUP BY ALL) GROUP BY {C}, tool) USING ({C}, tool)""",
    "pairwise_agreement": f"""SELECT {C}, tool_a, tool_b, count(*) FILTER (list_contains(tools, tool_a)) AS clusters_a, count(*) FILTER (list_contains(tools, tool_b)) AS clusters_b,
    count(*) FILTER (list_contains(tools, tool_a) AND list_contains(tools, tool_b)) AS intersection, count(*) FILTER (list_contains(tools, tool_a) OR list_contains(tools, tool_b)) AS "union",
    round_even(CASE WHEN "union" > 0 THEN CAST(intersection AS DOUBLE) / "union" ELSE 0.0::DOUBLE END, 6) AS jaccard
    FROM cl CROSS JOIN (VALUES ('semgrep', 'snyk'), ('semgrep', 'sonar'), ('semgrep', 'aikido'), ('snyk', 'sonar'), ('snyk', 'aikido'), ('sonar', 'aikido')) AS ps(tool_a, tool_b) GROUP BY {C}, tool_a, tool_b""",
    "consensus_queue": f"""SELECT {C}, CAST(row_number() OVER (PARTITION BY {C} ORDER BY {_AGR_ORDER}) AS INT) AS rank, file_path, start_line, end_line, cluster_id, array_to_string(tools, ',') AS tools, tool_count, CAST(tool_count AS DOUBLE) / 4 AS agreement_fraction,
    CASE tool_count WHEN 0 THEN 'none' WHEN 1 THEN 'single' WHEN 4 THEN 'unanimous' ELSE 'multi' END AS consensus_level, finding_count AS total_findings, max_severity, first_rule_id AS sample_rule_id, first_title AS sample_title FROM cl""",
    "consensus_summary": f"SELECT {C}, tool_count, count(*) AS clusters FROM cl GROUP BY ALL",
    "taxonomy": f"""SELECT {C}, tool, owasp_2021_code, count(*) AS "count", any_value(total) AS tool_total_findings
    FROM (SELECT {C}, tool, total, unnest(coalesce(codes, ['UNCLASSIFIED'])) AS owasp_2021_code FROM (SELECT *, count(*) OVER (PARTITION BY {C}, tool) AS total, 'CWE-' || regexp_extract(cwe_id, '[0-9]+') AS cwe FROM items) LEFT JOIN cwe_map USING (cwe)) GROUP BY {C}, tool, owasp_2021_code""",
    "gt_match": "SELECT * FROM matches",
    "gt_summary": _summary(),
    "gt_summary_by_set": _summary("set_name"),
    "gt_summary_by_track": _summary("track"),
    "gt_track_sast": f"SELECT {C}, count(*) AS gt_items, count(*) FILTER (matched) AS gt_matched, round_even(CAST(count(*) FILTER (matched) AS DOUBLE) / count(*), 6) AS match_rate FROM matches WHERE track = 'sast' GROUP BY ALL",
    "gt_tool_recall": f"""SELECT {C}, tool, count(*) AS gt_matched, any_value(n) AS gt_items, round_even(CAST(count(*) AS DOUBLE) / any_value(n), 6) AS recall
    FROM (SELECT *, count(*) OVER (PARTITION BY {C}) AS n FROM matches), unnest(string_split(matched_tools, ',')) AS u(tool) WHERE matched GROUP BY {C}, tool""",
    "gt_gap_queue": "SELECT * FROM gaps",
    "gt_gap_summary": f"SELECT {C}, reason, count(*) AS gaps, any_value(n) AS gt_total, round_even(CAST(count(*) AS DOUBLE) / any_value(n), 6) AS gap_rate FROM gaps JOIN (SELECT {C}, count(*) AS n FROM gt GROUP BY ALL) USING ({C}) GROUP BY {C}, reason",
    "gt_set_scores": f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1 FROM (
    SELECT {C}, count(*) FILTER (e AND s) AS tp, count(*) FILTER (s) AS found, count(*) FILTER (e) AS expected, coalesce(CAST(count(*) FILTER (e AND s) AS DOUBLE) / nullif(count(*) FILTER (s), 0), 0) AS precision, coalesce(CAST(count(*) FILTER (e AND s) AS DOUBLE) / nullif(count(*) FILTER (e), 0), 0) AS recall
    FROM (SELECT {C}, file, line, bool_or(e) AS e, bool_or(s) AS s FROM (SELECT {C}, file, start_line AS line, true AS e, false AS s FROM gt UNION ALL SELECT {C}, file, line, false, true FROM spots) GROUP BY {C}, file, line) GROUP BY {C})""",
    "triage_queue_baseline": f"SELECT {_QUEUE.format(score='')} FROM queue",
    "triage_queue_calibrated": f"SELECT {_QUEUE.format(score='triage_score_v1, ')} FROM (SELECT * EXCLUDE (rank), s_own AS triage_score_v1, CAST(row_number() OVER (PARTITION BY {C} ORDER BY s_own DESC, {_SEV_ORDER}) AS INT) AS rank FROM scored)",
    "triage_features": f"""SELECT {C}, cluster_id, 'triage_features_v1' AS schema_version, 'repo' AS repo_name, '' AS repo_url, '' AS repo_ref, '' AS repo_git_commit, '' AS repo_git_branch, '' AS repo_expected_commit, '' AS repo_expected_branch, '' AS case_track, '{{}}' AS case_tags_json,
    owasp_id, CASE owasp_id {_TITLES} END AS owasp_title, file_path, coalesce(start_line, 0) AS start_line, coalesce(end_line, 0) AS end_line, CASE WHEN start_line > 0 THEN end_line - start_line + 1 ELSE 0 END AS line_span,
    to_json(tools)::VARCHAR AS tools_json, array_to_string(tools, ',') AS tools, tool_count, 4 AS suite_tool_count, round_even(CAST(tool_count AS DOUBLE) / 4, 6) AS agreement_tool_ratio, {_COUNTS_JSON} AS tool_counts_json, finding_count,
    {", ".join(f"{t}_count" for t in TOOLS)}, CAST(0 AS BIGINT) AS other_tool_count, max_severity, max_severity_rank, severity_high_count, severity_medium_count, severity_low_count, severity_unknown_count, unique_rule_count, unique_title_count, unique_finding_id_count,
    rank AS triage_rank, sample_tool, sample_rule_id, sample_title, sample_severity, gt_overlap, CAST(len(gt_ids) AS INT) AS gt_overlap_count, {_LISTS} FROM feat""",
    "calibration_global": "SELECT * FROM w_all",
    "calibration_by_owasp": "SELECT * FROM w_own",
    "suspicious_cases": f"SELECT {C}, count(*) AS cluster_count, CAST(sum(gt_overlap) AS BIGINT) AS gt_overlap_sum FROM lab GROUP BY {C} HAVING sum(gt_overlap) = 0",
    **{f"rank_{s}": f"SELECT {C}, strategy, rank, cluster_id, triage_score_v1 FROM ranked WHERE strategy = '{s}'" for s in ("baseline", "agreement", "calibrated_global", "calibrated")},
    "eval_cases": f"SELECT {C}, n_clusters, gt_total, has_gt = 1 AS with_gt, has_gt = 0 AS without_gt, n_clusters = 0 AS no_clusters, has_gt = 1 AND n_clusters = 0 AS gt_but_no_clusters, has_gt = 1 AND n_clusters > 0 AND positives = 0 AS gt_but_no_overlaps FROM cases",
    "eval_topk": f"""SELECT {C}, r.strategy, r.rank, cluster_id, tool_count, array_to_string(tools, ',') AS tools, max_severity, max_severity_rank, finding_count, file_path, coalesce(start_line, 0) AS start_line, triage_rank, triage_score_v1, gt_overlap, array_to_string(gt_ids, ';') AS gt_overlap_ids,
    CASE WHEN has_gt = 1 THEN CAST(len(gt_ids) AS INT) ELSE 0 END AS gt_overlap_ids_count, has_gt, gt_total, CASE WHEN has_gt = 1 THEN n END AS cumulative_gt_covered, round_even(CASE WHEN has_gt = 1 THEN CAST(n AS DOUBLE) / gt_total END, 6) AS cumulative_gt_coverage
    FROM (SELECT *, CAST(len(list_distinct(flatten(list(gt_ids) OVER (PARTITION BY {C}, strategy ORDER BY rank)))) AS BIGINT) AS n FROM ranked) r JOIN cases USING ({C})""",
    "eval_by_case": "SELECT * FROM by_case",
    "eval_macro": "SELECT * FROM macro",
    "eval_micro": "SELECT * FROM micro",
    "eval_deltas": _against("by_case", C, "c.n_clusters, c.has_gt, c.gt_total, b.precision AS baseline_precision, c.precision AS strategy_precision, b.gt_coverage AS baseline_gt_coverage, c.gt_coverage AS strategy_gt_coverage, "),
    "eval_suite_deltas": _against("macro", "suite_id", ""),
    "eval_topk_focus": "SELECT 'macro' AS agg, suite_id, strategy, k, precision, gt_coverage FROM macro WHERE k >= 10 AND strategy <> 'agreement' UNION ALL SELECT 'micro', suite_id, strategy, k, precision, gt_coverage FROM micro WHERE k >= 10 AND strategy <> 'agreement'",
    "tool_utility": "SELECT * FROM utility",
    "tool_marginal": "SELECT * FROM marginal",
    "tolerance_sweep": "SELECT * FROM sweep",
    "tolerance_auto": """SELECT suite_id, min(gt_tolerance) AS selected_gt_tolerance, max(most) AS max_gt_positive_clusters, max(needed) AS required_min, false AS analysis_rc_filter_applied, arg_min(clusters_multi_gt, gt_tolerance) AS clusters_multi_gt, arg_min(gt_ids_multi_cluster, gt_tolerance) AS gt_ids_multi_cluster
    FROM sweep JOIN peaks USING (suite_id) WHERE gt_overlap_1 >= needed GROUP BY suite_id""",
    "tolerance_by_case": f"SELECT {C}, gt_tolerance, count(DISTINCT cluster_id) AS gt_overlap_1 FROM pairs GROUP BY ALL",
    "gt_ambiguity": """SELECT suite_id, gt_tolerance, array_to_string(list_filter([CASE WHEN clusters_multi_gt > 0 THEN 'many_to_one_clusters=' || clusters_multi_gt END, CASE WHEN gt_ids_multi_cluster > 0 THEN 'one_to_many_gt_ids=' || gt_ids_multi_cluster END,
    CASE WHEN max_gt_ids_per_cluster > 1 THEN 'max_gt_ids_per_cluster=' || max_gt_ids_per_cluster END, CASE WHEN max_clusters_per_gt_id > 1 THEN 'max_clusters_per_gt_id=' || max_clusters_per_gt_id END], lambda x: x IS NOT NULL), ';') AS warnings FROM sweep WHERE gt_tolerance = 3""",
    "dataset_counts": "SELECT * FROM counts",
    "clusters_by_tool": "SELECT suite_id, tool, count(*) AS clusters FROM (SELECT suite_id, unnest(tools) AS tool FROM feat) GROUP BY ALL",
    "mart_fact_eval_case_k": "SELECT suite_id AS suite_run_id, 'benchmark' AS benchmark_id, case_id, strategy, k, n_clusters, has_gt, gt_total, coalesce(precision, 0) AS precision_at_k, tp_at_k, denom_at_k, coalesce(gt_coverage, 0) AS coverage_at_k, gt_covered_at_k FROM by_case",
    "mart_fact_eval_suite_k": """SELECT suite_id AS suite_run_id, 'benchmark' AS benchmark_id, 'macro' AS agg_type, strategy, k, coalesce(precision, 0) AS precision_at_k, coalesce(gt_coverage, 0) AS coverage_at_k, precision_cases, gt_coverage_cases AS coverage_cases, CAST(0 AS BIGINT) AS tp_at_k, CAST(0 AS BIGINT) AS denom_at_k, CAST(0 AS BIGINT) AS gt_covered_at_k, CAST(0 AS BIGINT) AS gt_total FROM macro
    UNION ALL SELECT suite_id, 'benchmark', 'micro', strategy, k, coalesce(precision, 0), coalesce(gt_coverage, 0), 0, 0, tp_at_k, denom_at_k, gt_covered_at_k, gt_total FROM micro""",
    "mart_fact_tool_value": "SELECT suite_id AS suite_run_id, 'benchmark' AS benchmark_id, tool, metric_group, strategy, k, metric_name, metric_value FROM ("
    + " UNION ALL ".join(f"SELECT suite_id, tool, 'utility' AS metric_group, '' AS strategy, NULL::INT AS k, 'utility.{m}' AS metric_name, CAST({m} AS DOUBLE) AS metric_value FROM utility" for m in _UTILITY)
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT suite_id, tool, 'marginal', strategy, k, 'marginal.' || strategy || '.k' || k || '.{m}', CAST({m} AS DOUBLE) FROM marginal" for m in _MARGINAL)
    + ") WHERE metric_value IS NOT NULL",
    "mart_dim_case": f"""SELECT 'benchmark' AS benchmark_id, case_id, 'cases/' || case_id AS case_dir, upper(substr(case_id, 11, 3)) AS owasp_id, CASE upper(substr(case_id, 11, 3)) {_TITLES} END AS owasp_title, has_gt, gt_total, '' AS track, '' AS repo_label, '' AS runs_repo_name,
    '' AS expected_branch, '' AS expected_commit, '' AS tags_json FROM cases""",
    "mart_dim_suite_run": """SELECT suite_id AS suite_run_id, 'benchmark' AS benchmark_id, 3 AS analysis_tolerance, 'security' AS analysis_filter, 0 AS gt_tolerance_effective, to_json(list_sort(list(DISTINCT tool)))::VARCHAR AS scanners_json, sha256(to_json(list_sort(list(DISTINCT tool)))::VARCHAR) AS toolset_signature FROM f GROUP BY suite_id""",
    "mart_strategy_ab": "SELECT case_id, max(coalesce(gt_coverage, 0)) FILTER (strategy = 'calibrated') - max(coalesce(gt_coverage, 0)) FILTER (strategy = 'baseline') AS delta_coverage FROM by_case WHERE k = 25 GROUP BY case_id",
}

ORACLE_SQL = {name: sql(text) for name, text in SELECTS.items()} | {"suite_compare": _compare()}


def _unique(values: str) -> str:
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


def _mapped(codes: dict[str, list[str]]) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v}" for k, v in codes.items()) + "}"


def _text(values: str) -> str:
    return f"nullif(array_to_string({values}, ','), '')"


def _padded(number: str) -> str:
    return f"'A' || lpad(CAST(CAST({number} AS INT) AS VARCHAR), 2, '0')"


_DIGITS = r"'(?i)\bA([0-9]{1,2})\b', 1"
VIEWS |= {
    "tagged": _adapted(TAGGED),
    "flawed": _adapted(FLAWED),
    "receipts": _adapted(RECEIPTS) + " UNION ALL " + _adapted(RECEIPTS, "suite_prev"),
    "rules": _adapted(RULES),
    "planned": f"SELECT 'suite_main' AS suite_id, unnest({list(CASES)}) AS case_id",
    "reports": f"SELECT DISTINCT {C}, tool FROM f UNION ALL SELECT 'suite_main', '{CASES[10]}', unnest(['semgrep', 'snyk'])",
    "listed": r"""SELECT *, list_filter(list_transform(list_concat([cwe_id], regexp_extract_all(coalesce(description, ''), '(?i)\bCWE[-_ ]?([0-9]{1,6})\b', 1)), lambda x: 'CWE-' || TRY_CAST(regexp_extract(x, '([0-9]{1,6})', 1) AS INT)), lambda x: x IS NOT NULL) AS ids,
    string_split(coalesce(tags_text, ''), '|') AS tags, string_split(vendor_text, '|') AS vendor FROM tagged""",
    "coded": f"""SELECT *, {_unique("ids")} AS cwes, flatten(list_transform(list_filter(tags, lambda t: contains(t, '2017')), lambda t: regexp_extract_all(t, {_DIGITS}))) AS of_2017,
    flatten(list_transform(list_filter(tags, lambda t: contains(t, '2021') OR (contains(lower(t), 'owasp') AND NOT contains(t, '2017'))), lambda t: regexp_extract_all(t, {_DIGITS}))) AS of_2021,
    list_transform(list_filter(vendor, lambda v: regexp_matches(v, '(?i)^a[0-9]+$')), lambda v: {_padded("substr(v, 2)")}) AS given FROM listed""",
    "implied": f"""SELECT *, list_transform(of_2017, lambda n: 'A' || CAST(n AS INT)) AS v17, list_transform(of_2021, lambda n: {_padded("n")}) AS tag21,
    flatten(list_transform(cwes, lambda c: coalesce({_mapped(CWE_OWASP_2017)}[c], []))) AS c17, flatten(list_transform(cwes, lambda c: coalesce({_mapped(CWE_OWASP)}[c], []))) AS c21 FROM coded""",
    "six": f"""SELECT tool, cwes, {_text(_unique("v17"))} AS t17, coalesce({_text(_unique("tag21"))}, {_text(_unique("given"))}) AS t21, {_text(_unique("c17"))} AS i17, {_text(_unique("c21"))} AS i21 FROM implied""",
    "stated": "SELECT rule_key, name, string_split(tags_text, '|') AS tags, string_split(standards_text, '|') AS standards FROM rules",
    "rule_ids": """SELECT *, list_filter(list_transform(list_concat(list_transform(list_filter(standards, lambda s: s LIKE 'cwe:%'), lambda s: substr(s, 5)), list_transform(list_filter(tags, lambda t: regexp_matches(t, '^cwe-[0-9]+$')), lambda t: substr(t, 5))),
    lambda x: 'CWE-' || TRY_CAST(x AS INT)), lambda x: x IS NOT NULL) AS ids FROM stated""",
    "ruled": f"""SELECT rule_key, name AS vuln_class, {_unique("ids")} AS cwes, {_text("list_transform(list_filter(standards, lambda s: s LIKE 'owaspTop10-2017:%' OR s LIKE 'owaspTop10:%'), lambda s: 'A' || regexp_extract(s, ':a([0-9]+)$', 1))")} AS o17,
    {_text("list_transform(list_filter(standards, lambda s: s LIKE 'owaspTop10-2021:%'), lambda s: " + _padded("regexp_extract(s, ':a([0-9]+)$', 1)") + ")")} AS o21 FROM rule_ids""",
    "raw_n": f"SELECT {C}, tool, count(*) AS n FROM f GROUP BY ALL",
    "kept_n": f"SELECT {C}, tool, count(*) AS kept FROM items GROUP BY ALL",
    "run_n": f"SELECT {C}, tool, coalesce(n, 0) AS n, coalesce(kept, 0) AS kept FROM reports LEFT JOIN raw_n USING ({C}, tool) LEFT JOIN kept_n USING ({C}, tool)",
    "run_sum": f"""SELECT {C}, list_sort(list(tool)) AS used, list_sort(coalesce(list(tool) FILTER (n = 0), [])) AS hollow, list_sort(coalesce(list(tool) FILTER (n > 0 AND kept = 0), [])) AS unkept,
    CAST(sum(n) AS BIGINT) AS findings, CAST(sum(kept) AS BIGINT) AS findings_kept FROM run_n GROUP BY {C}""",
    "cl_sum": f"SELECT {C}, count(*) AS clusters, max(max_severity_rank) AS top FROM cl GROUP BY {C}",
    "gt_sum": f"SELECT {C}, count(*) AS gt_total, count(*) FILTER (matched) AS gt_matched FROM matches GROUP BY {C}",
    "case_rep": f"""SELECT {C}, coalesce(used, []) AS used, list_sort(list_filter({list(TOOLS)}, lambda t: NOT list_contains(coalesce(used, []), t))) AS lacking, coalesce(hollow, []) AS hollow, coalesce(unkept, []) AS unkept,
    coalesce(findings, 0) AS findings, coalesce(findings_kept, 0) AS findings_kept, coalesce(clusters, 0) AS clusters, coalesce(gt_total, 0) AS gt_total, coalesce(gt_matched, 0) AS gt_matched,
    round_even(CASE WHEN gt_total > 0 THEN CAST(gt_matched AS DOUBLE) / gt_total END, 6) AS match_rate, gt_total - gt_matched AS gap_total, ['', 'LOW', 'MEDIUM', 'HIGH'][CAST(coalesce(top, 0) AS INT) + 1] AS top_severity
  FROM planned LEFT JOIN run_sum USING ({C}) LEFT JOIN cl_sum USING ({C}) LEFT JOIN gt_sum USING ({C})""",
    "todo": f"""SELECT {C}, 'missing_outputs' AS kind, '' AS subject FROM case_rep WHERE len(lacking) > 0 UNION ALL SELECT {C}, 'no_clusters', '' FROM case_rep WHERE clusters = 0
    UNION ALL SELECT {C}, 'empty_results', unnest(hollow) FROM case_rep UNION ALL SELECT {C}, 'filtered_to_zero', unnest(unkept) FROM case_rep""",
    "shown": f"""SELECT {C}, cluster_id, coalesce(tool, '') || ':' || coalesce(severity, '') || ':' || coalesce(rule_id, '') || ':' || coalesce(title, '') || ':' || coalesce(finding_id, '') AS example,
    row_number() OVER (PARTITION BY {C}, cluster_id ORDER BY {_SEQ}) AS n FROM named QUALIFY n <= 5""",
    "hot": f"SELECT *, CAST(row_number() OVER (PARTITION BY {C} ORDER BY file_path, coalesce(start_line, 0), cluster_id) AS INT) AS place FROM cl QUALIFY place <= 200",
    "tables_there": "SELECT suite_id, case_id, 1 AS there FROM planned WHERE case_id NOT IN ('owasp2021-a10-case', 'owasp2021-a12-case')",
    "feat_n": f"SELECT {C}, count(*) AS n, count(*) FILTER (case_id = 'owasp2021-a02-case' AND rank > 1) AS others FROM feat WHERE case_id NOT IN ('owasp2021-a09-case', 'owasp2021-a10-case') GROUP BY {C}",
}
_EXPECTED = ("finding_id", "rule_id", "title", "file_path", "line_number", "severity")
_WARNINGS = """concat_ws('; ', CASE WHEN len(ps) > 1 THEN 'multiple profiles observed: [''' || array_to_string(ps, ''', ''') || ''']' END, 'missing config_receipt for tools: [''aikido'']',
    CASE WHEN len(several) > 0 THEN 'multiple config signatures detected for tools: [''' || array_to_string(several, ''', ''') || ''']' END)"""
ADDED = {
    "finding_classification": """SELECT tool, cwes[1] AS cwe_id, coalesce(array_to_string(cwes, ','), '') AS cwe_ids, coalesce(i17, t17) AS owasp_top_10_2017, t17 AS owasp_top_10_2017_vendor, i17 AS owasp_top_10_2017_canonical,
    coalesce(t21, i21) AS owasp_top_10_2021, t21 AS owasp_top_10_2021_vendor, i21 AS owasp_top_10_2021_canonical, count(*) AS findings FROM six GROUP BY ALL""",
    "finalized_findings": f"SELECT {C}, tool, finding_id, file_path, line_number, coalesce(array_to_string(list_sort(cwes), ','), '') AS cwe_ids FROM coded",
    "finding_problems": "SELECT tool, problem, count(*) AS findings FROM ("
    + " UNION ALL ".join(f"SELECT tool, 'missing:{c}' AS problem FROM flawed WHERE coalesce({c}, '') = ''" for c in _EXPECTED[:3])
    + " UNION ALL SELECT tool, 'invalid:severity' FROM flawed WHERE severity NOT IN ('', 'HIGH', 'MEDIUM', 'LOW')"
    + "".join(f" UNION ALL SELECT tool, 'invalid:{c}' FROM flawed WHERE {c} IS NOT NULL AND TRY_CAST({c} AS INT) IS NULL" for c in ("line_number", "end_line_number"))
    + ") GROUP BY ALL",
    "rule_classification": "SELECT rule_key, vuln_class, coalesce(array_to_string(cwes, ','), '') AS cwe_ids, o17 AS owasp_top_10_2017, o21 AS owasp_top_10_2021 FROM ruled",
    "rule_enrichment": """SELECT rule_id, coalesce(cwe_id, cwes[1]) AS cwe_id, coalesce(array_to_string(cwes, ','), '') AS cwe_ids, coalesce(vuln_class, 'own') AS vuln_class, o21 AS owasp_top_10_2021, count(*) AS findings
    FROM f LEFT JOIN ruled ON rule_id = rule_key WHERE tool = 'sonar' GROUP BY ALL""",
    "schema_gaps": " UNION ALL ".join(f"SELECT suite_id, tool, '{c}' AS field, count(*) AS findings, count(*) FILTER (coalesce(CAST({c} AS VARCHAR), '') = '') AS missing FROM flawed GROUP BY suite_id, tool" for c in _EXPECTED),
    "empty_runs": f"SELECT {C}, tool FROM reports ANTI JOIN f USING ({C}, tool)",
    "scanner_config": f"""SELECT suite_id, CASE len(ps) WHEN 0 THEN NULL WHEN 1 THEN ps[1] ELSE 'mixed' END AS profile, CASE len(ps) WHEN 0 THEN 'unknown' WHEN 1 THEN 'uniform' ELSE 'mixed' END AS profile_mode, config_hashes, receipts_found, tools_seen,
    'aikido' AS missing_tools, {_WARNINGS} AS warnings
  FROM (SELECT suite_id, list_sort(list(DISTINCT trim(profile)) FILTER (trim(profile) <> '')) AS ps, count(*) AS receipts_found, array_to_string(list_sort(list(DISTINCT tool)), ',') AS tools_seen FROM receipts GROUP BY suite_id)
  JOIN (SELECT suite_id, string_agg(tool || '=' || array_to_string(hs, ','), ';' ORDER BY tool) AS config_hashes, list_sort(coalesce(list(tool) FILTER (len(hs) > 1), [])) AS several
    FROM (SELECT suite_id, tool, list_sort(list(DISTINCT config_hash)) AS hs FROM receipts GROUP BY suite_id, tool) GROUP BY suite_id) USING (suite_id)""",
    "case_report": """SELECT * EXCLUDE (used, lacking, hollow, unkept), array_to_string(used, ',') AS tools_used, array_to_string(lacking, ',') AS tools_missing, array_to_string(hollow, ',') AS empty_tools,
    array_to_string(unkept, ',') AS filtered_to_zero_tools FROM case_rep""",
    "action_items": """SELECT suite_id, kind, subject, count(*) AS n, array_to_string(list_sort(list(case_id))[:3], ',') AS examples FROM todo GROUP BY suite_id, kind, subject
    UNION ALL SELECT DISTINCT suite_id, 'below_min_support', owasp_id, support_clusters, '' FROM w_own WHERE fallback_to_global = 1""",
    "report_pointers": """SELECT suite_id, 'gt_gap' AS list, CAST(row_number() OVER (PARTITION BY suite_id ORDER BY gap_total DESC, case_id) AS INT) AS place, case_id, CAST(gap_total AS VARCHAR) AS value FROM case_rep WHERE gap_total IS NOT NULL QUALIFY place <= 3
    UNION ALL SELECT suite_id, 'severity', CAST(row_number() OVER (PARTITION BY suite_id ORDER BY list_position(['LOW', 'MEDIUM', 'HIGH'], top_severity) DESC NULLS LAST, clusters DESC, case_id) AS INT) AS place, case_id, top_severity FROM case_rep QUALIFY place <= 3""",
    "hotspot_drilldown": f"""SELECT {C}, cluster_id, file_path, start_line, end_line, array_to_string(tools, ',') AS tools, tool_count, max_severity, place, examples
    FROM hot JOIN (SELECT {C}, cluster_id, string_agg(example, ';' ORDER BY n) AS examples FROM shown GROUP BY {C}, cluster_id) USING ({C}, cluster_id)""",
    "scoreboard": f"SELECT {C}, count(*) AS triage_items, max(tool_count) FILTER (rank = 1) AS top_agreement, count(*) FILTER (tool_count > 1) AS consensus_items, "
    + ", ".join(f"count(*) FILTER (list_contains(tools, '{t}')) AS {t}_clusters" for t in TOOLS)
    + f" FROM queue GROUP BY {C}",
    "dataset_audit": f"""SELECT {C}, CASE WHEN there IS NULL AND n IS NULL THEN 'missing' WHEN n IS NULL THEN 'empty' WHEN others > 0 THEN 'mismatch' ELSE 'ok' END AS status, coalesce(n, 0) AS n_rows,
    CASE WHEN others > 0 THEN 'triage_features_v0' WHEN n > 0 THEN 'triage_features_v1' END AS schema_version FROM planned LEFT JOIN tables_there USING ({C}) LEFT JOIN feat_n USING ({C})""",
}


def _at_tolerances(text: str) -> str:
    """The rows of a query at each tolerance of the ground truth."""
    one = sql(text)
    return " UNION ALL ".join(f"SELECT *, {t} AS gt_tolerance FROM ({one.replace('WHERE gt_tolerance = 0', f'WHERE gt_tolerance = {t}')})" for t in (0, 1, 2, 3, 5, 10))


ORACLE_SQL |= {name: sql(text) for name, text in ADDED.items()}
ORACLE_SQL |= {"tolerance_tools": _at_tolerances(SELECTS["calibration_global"]), "tolerance_macro": _at_tolerances(SELECTS["eval_macro"])}


def _report() -> str:
    """Overlap counts beside the macro metrics of each tolerance, turned to columns."""
    wide = [f"max({m}) FILTER (strategy = '{s}' AND k = {k}) AS macro_{m}_{s}_k{k}" for m in ("precision", "gt_coverage") for s in ("baseline", "agreement", "calibrated") for k in (1, 3, 5, 10, 25)]
    above = [f"round_even(macro_{m}_calibrated_k{k} - macro_{m}_baseline_k{k}, 6) AS delta_macro_{m}_calibrated_vs_baseline_k{k}" for m in ("precision", "gt_coverage") for k in (1, 3, 5, 10, 25)]
    told = ", ".join(f"CASE WHEN {c} > {least} THEN '{name}=' || {c} END" for c, name, least in (("clusters_multi_gt", "many_to_one_clusters", 0), ("gt_ids_multi_cluster", "one_to_many_gt_ids", 0), ("max_gt_ids_per_cluster", "max_gt_ids_per_cluster", 1), ("max_clusters_per_gt_id", "max_clusters_per_gt_id", 1)))
    return f"""SELECT * EXCLUDE (told), CASE WHEN len(told) > 0 THEN 1 ELSE 0 END AS gt_ambiguity_warning, len(told) AS gt_ambiguity_warning_count,
      '[' || array_to_string(list_transform(told, lambda w: '"' || w || '"'), ', ') || ']' AS gt_ambiguity_warnings_json, {", ".join(above)}
    FROM (SELECT *, clusters_multi_gt AS many_to_one_clusters, gt_ids_multi_cluster AS one_to_many_gt_ids, list_filter([{told}], lambda w: w IS NOT NULL) AS told FROM ({sql(SELECTS["tolerance_sweep"])})) counts
    LEFT JOIN (SELECT suite_id, gt_tolerance, {", ".join(wide)} FROM ({ORACLE_SQL["tolerance_macro"]}) GROUP BY suite_id, gt_tolerance) wide USING (suite_id, gt_tolerance)"""


ORACLE_SQL["tolerance_report"] = _report()

# What payloads of each shape stand for, told from their numbers alone.
ORACLE_SQL["payload_classification"] = """
WITH numbered AS (
  SELECT o_orderkey, o_orderkey % 6 AS shape, 'CWE-' || (20 + o_orderkey % 70) AS n, 'CWE-' || (21 + o_orderkey % 70) AS m, o_custkey % 9 + 1 AS c FROM orders
)
SELECT o_orderkey, CASE shape WHEN 0 THEN m || ',' || n WHEN 1 THEN n || ',' || m WHEN 3 THEN 'CWE-5,' || n || ',' || m ELSE '' END AS cwe_ids,
  CASE shape WHEN 1 THEN 'A0' || c WHEN 2 THEN CASE WHEN c = 2 THEN 'A02' ELSE 'A0' || c || ',A02' END WHEN 3 THEN 'A0' || c ELSE '' END AS vendor_codes,
  CASE shape WHEN 0 THEN 'owasp:A' || c || '|x|Flaw of ' || n WHEN 2 THEN 'L' || substr(m, 5) ELSE '' END AS tags
FROM numbered
"""

_RULE_KEYS = """
SELECT DISTINCT p_partkey % 25 AS k, 'A0' || (p_partkey % 25 % 9 + 1) AS code, 'CWE-' || (p_partkey % 25) AS cwe FROM part
"""
# Keys, and what they stand for, rule by rule.
_INDEX = f"""
SELECT 'Rule_' || k || ' name' AS rule_key, code AS owasp_codes, cwe AS cwe_ids FROM ({_RULE_KEYS}) WHERE k % 4 = 0
UNION ALL SELECT 'rule ' || k || ' name', code, cwe FROM ({_RULE_KEYS}) WHERE k % 4 = 0
UNION ALL SELECT 'R' || k, code || ',A10', '' FROM ({_RULE_KEYS}) WHERE k % 4 = 1
UNION ALL SELECT 'R' || k, code, cwe || ',CWE-99' FROM ({_RULE_KEYS}) WHERE k % 4 = 2
UNION ALL SELECT 'rule ' || k, code, cwe || ',CWE-99' FROM ({_RULE_KEYS}) WHERE k % 4 = 2
UNION ALL SELECT 'R' || k, code, '' FROM ({_RULE_KEYS}) WHERE k % 4 = 3
UNION ALL SELECT 'Rule  ' || k, '', 'CWE-7' FROM ({_RULE_KEYS}) WHERE k % 4 = 3
UNION ALL SELECT 'rule ' || k, '', 'CWE-7' FROM ({_RULE_KEYS}) WHERE k % 4 = 3
"""
ORACLE_SQL["vendor_rule_index"] = _INDEX
ORACLE_SQL["vendor_rule_findings"] = f"""
WITH found AS ({_adapted(NAMED_RULES)}), known AS ({_INDEX})
SELECT rule_id, rule_name, coalesce(a.owasp_codes, b.owasp_codes, '') AS rule_owasp_codes, CASE WHEN a.rule_key IS NOT NULL THEN a.cwe_ids ELSE coalesce(b.cwe_ids, '') END AS rule_cwe_ids, count(*) AS findings
FROM found LEFT JOIN known a ON a.rule_key = rule_id LEFT JOIN known b ON a.rule_key IS NULL AND b.rule_key = regexp_replace(lower(rule_name), ' +', ' ', 'g')
GROUP BY ALL
"""
# The folder of a tool run below its suite.
_TOOL_RUN = (
    "'cases/owasp2021-a' || lpad(CAST(l_suppkey % 10 + 1 AS VARCHAR), 2, '0') || '-case/tool_runs/' || "
    "CASE l_linenumber % 4 WHEN 0 THEN 'semgrep' WHEN 1 THEN 'snyk' WHEN 2 THEN 'sonar' ELSE 'aikido' END || '/202401010' || (l_orderkey % 3)"
)
ORACLE_SQL["mart_dim_tool_run"] = f"""
WITH runs AS (SELECT DISTINCT {_TOOL_RUN} AS run_dir, split_part({_TOOL_RUN}, '/', 2) AS case_id, split_part({_TOOL_RUN}, '/', 4) AS tool, l_orderkey % 3 AS r FROM lineitem)
SELECT 'suite_main' AS suite_run_id, 'benchmark' AS benchmark_id, case_id, tool, split_part(run_dir, '/', 5) AS run_id, 'p' || r AS profile, CASE WHEN r < 2 THEN '1.' || r ELSE '' END AS scanner_version, '' AS config_hash,
  sha256('{{"artifacts":{{"rules_inventory":{{"a":"x","b":[1,' || r || ']}}}},"profile":"q","schema_version":2,"tool":"' || tool || '"}}') AS config_receipt_hash, CAST(r AS BIGINT) AS exit_code, 's' || r AS started, '' AS finished,
  CASE WHEN r < 2 THEN r + 0.5::DOUBLE ELSE 0.0::DOUBLE END AS scan_time_seconds, CASE WHEN r < 2 THEN CAST(r + 1 AS INT) END AS normalized_findings, run_dir
FROM runs
"""
ORACLE_SQL["config_receipts"] = f"""
SELECT DISTINCT 'suite_main' AS suite_id, split_part({_TOOL_RUN}, '/', 2) AS case_id, split_part({_TOOL_RUN}, '/', 4) AS tool, {_TOOL_RUN} AS run_dir, 'q' AS profile,
  sha256('{{"artifacts":{{"rules_inventory":{{"a":"x","b":[1,' || (l_orderkey % 3) || ']}}}},"profile":"q","schema_version":2,"tool":"' || split_part({_TOOL_RUN}, '/', 4) || '"}}') AS config_hash
FROM lineitem
"""
ORACLE_SQL["line_content"] = """
SELECT 'src/o' || o_orderkey || '.py' AS path, o_custkey % 7 AS line, CASE WHEN o_custkey % 7 BETWEEN 1 AND o_orderkey % 5 + 1 THEN 'line ' || (o_custkey % 7) || ' of ' || o_custkey END AS content FROM orders
"""

# Items of each source, and how a catalogue stands, by the shape of a case's documents.
ORACLE_SQL["gt_source_choice"] = f"""
WITH cases AS ({_adapted(GT_CASES)}), counted AS (
  SELECT suite_id, case_id, CASE trim(lower(gt_source)) WHEN 'markers' THEN 'markers' WHEN 'yaml' THEN 'yaml' WHEN 'off' THEN 'none' ELSE 'auto' END AS mode,
    CASE shape WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS markers, CASE shape WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 3 THEN 1 WHEN 7 THEN 1 ELSE 0 END AS listed,
    CASE WHEN shape = 2 THEN 'gt_catalog_yaml_error' WHEN shape IN (4, 6) THEN 'no_gt_catalog_yaml' WHEN shape = 5 THEN 'empty_gt_catalog_yaml' END AS fault
  FROM cases
), chosen AS (
  SELECT *, CASE WHEN mode IN ('auto', 'markers') AND markers > 0 THEN 'markers' WHEN mode IN ('auto', 'yaml') AND listed > 0 THEN 'yaml' END AS used FROM counted
)
SELECT suite_id, case_id, mode AS gt_source_mode, used AS gt_source_used,
  CASE WHEN used IS NOT NULL THEN NULL WHEN mode = 'none' THEN 'gt_disabled' WHEN mode = 'markers' THEN 'no_gt_markers' WHEN mode = 'yaml' THEN fault WHEN fault = 'gt_catalog_yaml_error' THEN fault ELSE 'no_gt' END AS reason,
  CAST(CASE used WHEN 'markers' THEN markers WHEN 'yaml' THEN listed ELSE 0 END AS BIGINT) AS n_items
FROM chosen
"""

# Cases told from the customers that the lists are made of.
ORACLE_SQL["case_lists_read"] = """
WITH numbered AS (
  SELECT c_nationkey AS list, c_custkey AS place, c_nationkey % 3 = 0 AS named, c_custkey % 2 = 0 AS has_path, c_custkey % 5 <> 0 AS has_key, c_custkey % 4 AS form, '/repos/' || c_name AS path, replace(c_name, '#', '_') AS name FROM customer
), cases AS (
  SELECT *, CASE WHEN named THEN CASE WHEN has_path THEN name ELSE 'key_' || place END WHEN form = 0 THEN name ELSE 'Case_' || place END AS case_id FROM numbered
  WHERE CASE WHEN named THEN has_path OR has_key ELSE form <> 1 END
)
SELECT list, place, case_id, case_id AS runs_repo_name, case_id AS label, CASE WHEN named AND NOT has_path THEN '' ELSE path END AS repo_path, CASE WHEN named AND NOT has_path THEN 'key #' || place ELSE '' END AS repo_key,
  CASE WHEN NOT named AND form > 1 THEN 'main' ELSE '' END AS branch, CASE WHEN named THEN 't' || place ELSE '' END AS track, '{}' AS tags_json
FROM cases
"""

ORACLE_SQL["suite_summary"] = """
SELECT 'suite_main' AS suite_id, CASE WHEN k % 4 = 0 THEN 'case-' || k ELSE 'id-' || k END AS "case", 't' || k AS finished, 'b,a' AS requested, CASE WHEN k % 2 = 0 THEN 'a,b' ELSE 'a' END AS ok,
  CASE WHEN k % 2 = 0 THEN '' ELSE 'b' END AS failed, CASE WHEN k % 5 = 0 THEN 'yes' ELSE 'no' END AS analysis, 'cases/case-' || k AS case_dir, '' AS triage_queue
FROM (SELECT DISTINCT p_partkey % 200 AS k FROM part)
"""
ORACLE_SQL["eval_macro_from_topk"] = f"""
WITH rows AS ({sql(SELECTS["eval_topk"])}), each AS (
  SELECT suite_id, case_id, strategy, k, count(*) AS denom, count(*) FILTER (gt_overlap = 1) AS tp, coalesce(arg_max(cumulative_gt_covered, rank), 0) AS covered, coalesce(max(gt_total), 0) AS total
  FROM rows JOIN (VALUES (10), (25), (50)) AS ks(k) ON rank <= k GROUP BY ALL
)
SELECT suite_id, strategy, k, round_even(avg(CAST(tp AS DOUBLE) / denom), 6) AS precision, round_even(avg(CASE WHEN total > 0 THEN CAST(covered AS DOUBLE) / total END), 6) AS gt_coverage FROM each GROUP BY ALL
"""
ORACLE_SQL["benchmark_pack"] = f"""
WITH a AS (SELECT * FROM ({sql("SELECT * FROM queue")})), b AS (SELECT * FROM ({sql(SELECTS["consensus_queue"])}))
SELECT suite_id, case_id, x.n AS triage_items, x.top AS top_agreement, x.items AS triage_queue_top, y.n AS consensus_items, y.top AS top_consensus, y.items AS consensus_queue_top
FROM (SELECT suite_id, case_id, count(*) AS n, max(tool_count) FILTER (rank = 1) AS top, string_agg(rank || '@' || cluster_id, ';' ORDER BY rank) FILTER (rank <= 200) AS items FROM a GROUP BY ALL) x
JOIN (SELECT suite_id, case_id, count(*) AS n, max(tool_count) FILTER (rank = 1) AS top, string_agg(rank || '@' || cluster_id, ';' ORDER BY rank) FILTER (rank <= 200) AS items FROM b GROUP BY ALL) y USING (suite_id, case_id)
"""
