"""Severity labels: ranks for ordering, and the mapping of each tool's words to HIGH, MEDIUM and LOW."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each tool's words for a severity.
RANKS = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
REPORT_RANKS = {"CRITICAL": 4, **RANKS}
SEMGREP = {"ERROR": "HIGH", "WARNING": "MEDIUM", "INFO": "LOW", "CRITICAL": "HIGH", "HIGH": "HIGH", "MEDIUM": "MEDIUM", "LOW": "LOW"}
SARIF = {"ERROR": "HIGH", "WARNING": "MEDIUM", "NOTE": "LOW", "NONE": "LOW"}
SONAR = {"BLOCKER": "HIGH", "CRITICAL": "HIGH", "MAJOR": "HIGH", "MINOR": "MEDIUM", "INFO": "LOW"}
GENERIC = {
    "CRITICAL": "HIGH", "CRIT": "HIGH", "BLOCKER": "HIGH", "MAJOR": "HIGH", "HIGH": "HIGH", "ERROR": "HIGH",
    "MEDIUM": "MEDIUM", "MODERATE": "MEDIUM", "WARNING": "MEDIUM", "WARN": "MEDIUM", "MINOR": "MEDIUM",
    "LOW": "LOW", "INFO": "LOW", "INFORMATIONAL": "LOW", "NOTE": "LOW", "NONE": "LOW",
}
# Parts of Aikido's words, the first that occurs counts.
AIKIDO_PARTS = {"CRITICAL": "HIGH", "HIGH": "HIGH", "MEDIUM": "MEDIUM", "LOW": "LOW", "INFO": "LOW"}


def _word(value: Column) -> Column:
    return F.upper(F.trim(F.coalesce(value, F.lit(""))))


def _ranked(value: Column, ranks: dict[str, int]) -> Column:
    found = F.lit(0)
    for word, rank in ranks.items():
        found = F.when(_word(value) == word, rank).otherwise(found)
    return found


def severity_rank(value: Column) -> Column:
    """3, 2, 1 for HIGH, MEDIUM, LOW in any case; anything else, CRITICAL included, is 0."""
    found = F.when(value.isNull(), 0)  # null and the usual spelling need no text made
    for word, rank in RANKS.items():
        found = found.when(value == word, rank)
    return found.otherwise(_ranked(value, RANKS))


def report_rank(value: Column) -> Column:
    """severity_rank with 4 for CRITICAL, as reports sort."""
    return _ranked(value, REPORT_RANKS)


def _mapped(value: Column, words: dict[str, str], other: str | None) -> Column:
    found = F.lit(other)
    for word, label in words.items():
        found = F.when(_word(value) == word, label).otherwise(found)
    return F.when(_word(value) == "", None).otherwise(found)


def semgrep_severity(value: Column) -> Column:
    """Null for null alone; words that aren't known, the empty one included, are MEDIUM."""
    return F.when(value.isNull(), None).otherwise(F.coalesce(_mapped(value, SEMGREP, "MEDIUM"), F.lit("MEDIUM")))


def sarif_severity(level: Column) -> Column:
    return _mapped(level, SARIF, "MEDIUM")


def sonar_severity(value: Column) -> Column:
    return _mapped(value, SONAR, None)


def generic_severity(value: Column, tool: str | None = None) -> Column:
    """A score (7 and more is HIGH, 4 MEDIUM, above 0 LOW) or a word; null where neither is known.

    A score has digits and at most one point, without a sign.  Of tool aikido, words that hold a known one count too.
    """
    word = _word(value)
    score = F.when(word.rlike(r"^(?=.*[0-9])[0-9]*\.?[0-9]*$"), word.try_cast("double"))
    banded = F.when(score >= 7, "HIGH").when(score >= 4, "MEDIUM").when(score > 0, "LOW")
    found = _mapped(value, GENERIC, None)
    if tool == "aikido":
        part = F.lit(None).cast("string")
        for known, label in reversed(AIKIDO_PARTS.items()):
            part = F.when(word.contains(known), label).otherwise(part)
        found = F.coalesce(found, part)
    return F.when(score.isNotNull(), banded).otherwise(found)


def bucket(value: Column) -> Column:
    """HIGH, MEDIUM, LOW or UNKNOWN."""
    return F.when(severity_rank(value) > 0, _word(value)).otherwise("UNKNOWN")
