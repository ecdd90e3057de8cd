"""The classification of findings: CWE ids, and OWASP codes as vendors name them and as the CWE ids imply them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.classification import codes_from_tags, normalize_cwe, normalize_owasp, owasp_block

EDITIONS = (2017, 2021)
#: The views of each edition, in the order in which a resolved one takes them.
PREFERENCE = {2017: ("canonical", "vendor"), 2021: ("vendor", "canonical")}


def _listed(value: Column) -> Column:
    return F.coalesce(value, F.array().cast("array<string>"))


def _named(pattern: str, texts: list[Column], listed: Column | None) -> Column:
    """What the pattern's first group finds in each of the texts, then in those of a list, in their order."""
    each = F.array(*[F.coalesce(t, F.lit("")) for t in texts]) if texts else F.array().cast("array<string>")
    every = each if listed is None else F.concat(each, _listed(listed))
    return F.flatten(F.transform(every, lambda t: F.regexp_extract_all(t, F.lit(pattern), 1)))


def _known(values: Column) -> Column:
    """The distinct values that aren't null, in order; null without any."""
    found = F.array_distinct(F.array_compact(values))
    return F.when(F.size(found) > 0, found)


def _codes(values: Column, year: int) -> Column:
    """The distinct codes of an edition that the values stand for, in order; null without any."""
    return _known(F.transform(values, lambda c: normalize_owasp(c, year)))


#: A CWE id named in a text, and a code of 2021.
CWE_NAMED, CODE_NAMED = r"(?i)\bCWE[-_ ]?([0-9]{1,6})\b", r"(?i)\bA0?(10|[1-9])\b"


def cwe_candidates(fields: list[Column], texts: list[Column], listed: Column | None = None) -> Column:
    """Distinct CWE ids, in order: those of a report's fields (lists of texts), then those that its texts name; empty for none."""
    found = F.concat(*map(_listed, fields), _named(CWE_NAMED, texts, listed))
    return F.array_distinct(F.array_compact(F.transform(found, normalize_cwe)))


def vendor_codes(fields: list[Column], texts: list[Column], listed: Column | None = None) -> Column:
    """Distinct codes of 2021, in order: those of a report's fields (lists of texts), then those that its texts name; empty for none."""
    numbers = F.transform(_named(CODE_NAMED, texts, listed), lambda n: F.concat(F.lit("A"), n))
    found = F.concat(*map(_listed, fields), numbers)
    return F.array_distinct(F.array_compact(F.transform(found, lambda x: normalize_owasp(x, 2021))))


def implied(findings: DataFrame, mapping: DataFrame) -> DataFrame:
    """(cwe_ids, canonical_2017, canonical_2021) of each distinct list of CWE ids; mapping: (cwe_id, owasp_2017, owasp_2021).

    Lists repeat from finding to finding, so the mapping meets each of them once.
    """
    lists = findings.where(F.size("cwe_ids") > 0).select("cwe_ids").distinct()
    each = lists.select("cwe_ids", F.posexplode("cwe_ids").alias("place", "cwe_id")).join(mapping, "cwe_id")
    codes = F.array_sort(F.collect_list(F.struct("place", *[_listed(F.col(f"owasp_{y}")).alias(f"owasp_{y}") for y in EDITIONS])))
    rows = each.groupBy("cwe_ids").agg(codes.alias("codes"))
    return rows.select("cwe_ids", *[_codes(F.flatten(F.col(f"codes.owasp_{y}")), y).alias(f"canonical_{y}") for y in EDITIONS])


def resolve(findings: DataFrame, mapping: DataFrame, use_2017_tags: bool = True) -> DataFrame:
    """findings (cwe_ids, owasp_tags, vendor_codes) with the first CWE id and six OWASP blocks.

    owasp_top_10_<edition>_vendor comes from the tags, for 2021 from vendor_codes where no tag has a code;
    _canonical comes from the CWE ids alone; the name without a suffix is the resolved view: for 2021 the vendor's
    before the canonical one, for 2017 the other way round.  A block without codes is null.
    """
    rows = findings.join(implied(findings, mapping), "cwe_ids", "left")
    tags = F.col("owasp_tags")
    rows = rows.withColumns({
        "vendor_2017": _known(codes_from_tags(tags, 2017)) if use_2017_tags else F.lit(None).cast("array<string>"),
        "vendor_2021": F.coalesce(_known(codes_from_tags(tags, 2021)), _codes(_listed(F.col("vendor_codes")), 2021)),
    })
    blocks = {f"owasp_top_10_{y}_{view}": owasp_block(F.col(f"{view}_{y}"), y) for y in EDITIONS for view in ("vendor", "canonical")}
    whole = {f"owasp_top_10_{y}": owasp_block(F.coalesce(*[F.col(f"{view}_{y}") for view in PREFERENCE[y]]), y) for y in EDITIONS}
    return rows.withColumns({"cwe_id": F.get("cwe_ids", F.lit(0)), **blocks, **whole}).drop(*[f"{view}_{y}" for y in EDITIONS for view in ("vendor", "canonical")])


def rule_classification(rules: DataFrame) -> DataFrame:
    """(rule_key, vuln_class, cwe_ids, owasp_top_10_2017, owasp_top_10_2021) of rules (rule_key, name, tags, standards).

    standards are texts like cwe:89 and owaspTop10-2021:a3; owaspTop10 without a year is of 2017.  Tags like cwe-89
    give further CWE ids.  Entries without a number are left out.
    """
    standards = F.transform(_listed(F.col("standards")), lambda s: F.lower(F.trim(s)))

    def codes(year: int, *starts: str) -> Column:
        of_year = F.filter(standards, lambda s: s.rlike("|".join(starts)))
        return owasp_block(F.array_compact(F.transform(of_year, lambda s: normalize_owasp(F.regexp_extract(s, "([^:]*)$", 1), year))), year)

    ids = F.transform(F.filter(standards, lambda s: s.startswith("cwe:")), lambda s: F.substring(s, 5, 1 << 20))
    tagged = F.transform(F.filter(_listed(F.col("tags")), lambda t: F.lower(F.trim(t)).rlike("^cwe-[0-9]+$")), lambda t: F.trim(t))
    cwes = F.array_distinct(F.array_compact(F.transform(F.concat(ids, tagged), normalize_cwe)))
    return rules.select("rule_key", F.col("name").alias("vuln_class"), cwes.alias("cwe_ids"), codes(2017, "owasptop10-2017", "owasptop10:").alias("owasp_top_10_2017"), codes(2021, "owasptop10-2021").alias("owasp_top_10_2021"))


def enriched(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """findings with what rule_classification() knows about their rule_id; what a rule lacks stays as it was."""
    known = rules.select(F.col("rule_key").alias("rule_id"), *[F.col(c).alias(f"_{c}") for c in rules.columns if c != "rule_key"])
    rows = findings.join(known, "rule_id", "left")
    ids = F.when(F.size("_cwe_ids") > 0, F.col("_cwe_ids"))
    new = {"cwe_id": F.coalesce(F.nullif("cwe_id", F.lit("")), F.get(ids, F.lit(0))), "cwe_ids": F.coalesce(ids, F.col("cwe_ids")), "vuln_class": F.coalesce(F.nullif("_vuln_class", F.lit("")), F.col("vuln_class"))}
    blocks = [f"owasp_top_10_{y}" for y in EDITIONS]
    new |= {c: F.coalesce(f"_{c}", c) if c in findings.columns else F.col(f"_{c}") for c in blocks}
    return rows.withColumns(new).select(*findings.columns, *[c for c in blocks if c not in findings.columns])
