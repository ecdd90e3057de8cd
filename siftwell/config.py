"""Settings of an analysis: plain values that every operator takes as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CalibrationParams:
    """Smoothing, clamps and score weights of the trust model."""

    alpha: float = 1.0
    beta: float = 1.0
    p_min: float = 0.01
    p_max: float = 0.99
    agreement_lambda: float = 0.5
    severity_bonus: dict[str, float] = field(default_factory=lambda: {"HIGH": 0.25, "MEDIUM": 0.10, "LOW": 0.0, "UNKNOWN": 0.0})
    min_support: int = 10


@dataclass(frozen=True)
class AnalysisConfig:
    """What one analysis of a suite is run with."""

    tools: tuple[str, ...] = ("semgrep", "snyk", "sonar", "aikido")
    repo_name: str = "repo"
    mode: str = "security"
    exclude_prefixes: tuple[str, ...] = ("benchmark",)
    tolerance: int = 3
    gt_tolerance: int = 0
    gt_tolerance_candidates: tuple[int, ...] = (0, 1, 2, 3, 5, 10)
    ks: tuple[int, ...] = (1, 3, 5, 10, 25, 50)
    calibration: CalibrationParams = field(default_factory=CalibrationParams)
