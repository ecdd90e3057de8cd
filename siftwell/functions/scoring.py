"""Numbers of the trust model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.config import CalibrationParams


def round6(value: Column) -> Column:
    """Six decimals, halves to even."""
    return F.bround(value, 6)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def smoothed_precision(tp: Column, fp: Column, params: CalibrationParams) -> Column:
    whole = (tp + fp).cast("double") + params.alpha + params.beta
    return F.when(whole > 0, (tp.cast("double") + params.alpha) / whole).otherwise(0.5)


def log_odds(p: Column, params: CalibrationParams) -> Column:
    clamped = F.greatest(F.lit(params.p_min), F.least(F.lit(params.p_max), p))
    return F.ln(clamped / (1 - clamped))


def severity_bonus(severity: Column, params: CalibrationParams) -> Column:
    """The bonus of a label in any case; others count as UNKNOWN."""
    found = F.lit(float(params.severity_bonus.get("UNKNOWN", 0.0)))
    for label, bonus in params.severity_bonus.items():
        found = F.when(F.upper(F.trim(F.coalesce(severity, F.lit("")))) == label, float(bonus)).otherwise(found)
    return found


def triage_score(tools: Column, tool_count: Column, severity: Column, weights: Column, params: CalibrationParams) -> Column:
    """Sum of the tools' weights (in the order of tools), agreement bonus and severity bonus; weights is a map."""
    base = F.aggregate(tools, F.lit(0.0), lambda acc, t: acc + F.coalesce(F.try_element_at(weights, t), F.lit(0.0)))
    agreement = params.agreement_lambda * F.greatest(tool_count - 1, F.lit(0)).cast("double")
    return base + agreement + severity_bonus(severity, params)


def delta(value: Column, base: Column) -> Column:
    """value - base to six decimals; null if either is."""
    return round6(value - base)
