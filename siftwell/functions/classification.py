"""CWE ids and OWASP Top 10 codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The titles of both editions.
TITLES = {
    2017: {
        "A1": "Injection", "A2": "Broken Authentication", "A3": "Sensitive Data Exposure", "A4": "XML External Entities (XXE)",
        "A5": "Broken Access Control", "A6": "Security Misconfiguration", "A7": "Cross-Site Scripting (XSS)",
        "A8": "Insecure Deserialization", "A9": "Using Components with Known Vulnerabilities", "A10": "Insufficient Logging & Monitoring",
    },
    2021: {
        "A01": "Broken Access Control", "A02": "Cryptographic Failures", "A03": "Injection", "A04": "Insecure Design",
        "A05": "Security Misconfiguration", "A06": "Vulnerable and Outdated Components", "A07": "Identification and Authentication Failures",
        "A08": "Software and Data Integrity Failures", "A09": "Security Logging and Monitoring Failures", "A10": "Server-Side Request Forgery",
    },
}


def normalize_cwe(value: Column) -> Column:
    """CWE-<number> from CWE-79, cwe:79, CWE 79 or a bare 79; null otherwise."""
    text = F.trim(value)
    named = F.regexp_extract(text, r"(?i)\bCWE[-_: ]*([0-9]{1,6})\b", 1)
    bare = F.regexp_extract(text, r"^([0-9]{1,6})$", 1)
    number = F.when(named != "", named).when(bare != "", bare).try_cast("int")
    return F.when(number > 0, F.concat(F.lit("CWE-"), number.cast("string")))


def _code(number: Column, year: int) -> Column:
    """A01 to A10, or A1 to A10; number is mentioned once, as it may stand for a pattern's match."""
    codes = F.array(*[F.lit(f"A{n:02}" if year == 2021 else f"A{n}") for n in range(1, 11)])
    return F.get(codes, number - 1)


def normalize_owasp(value: Column, year: int) -> Column:
    """A1 to A10 for 2017, A01 to A10 for 2021, from the first such token of a text; null otherwise."""
    return _code(F.regexp_extract(F.coalesce(value, F.lit("")), r"(?i)\bA([0-9]{1,2})\b", 1).try_cast("int"), year)


def owasp_id(value: Column) -> Column:
    """A01 to A10 if the whole text is such a code."""
    code = _code(F.regexp_extract(F.trim(F.coalesce(value, F.lit(""))), r"(?i)^A([0-9]{1,2})$", 1).try_cast("int"), 2021)
    return F.when(value.isin(*TITLES[2021]), value).otherwise(code)  # the usual spelling needs no pattern


def owasp_title(code: Column, year: int = 2021) -> Column:
    found = F.lit(None).cast("string")
    for key, title in TITLES[year].items():
        found = F.when(code == key, title).otherwise(found)
    return found


# Fixed value: the title that findings' categories give one code in place of that of TITLES.
CATEGORY_TITLES = {(2021, "A10"): "Server-Side Request Forgery (SSRF)"}


def category(code: Column, year: int) -> Column:
    """code:year-title."""
    title = owasp_title(code, year)
    for (edition, key), text in CATEGORY_TITLES.items():
        title = F.when(code == key, text).otherwise(title) if edition == year else title
    return F.concat(code, F.lit(f":{year}-"), title)


def owasp_block(codes: Column, year: int) -> Column:
    """struct(codes, categories) of distinct codes, or null for none."""
    known = F.array_distinct(F.filter(codes, lambda c: c.isNotNull()))
    block = F.struct(known.alias("codes"), F.transform(known, lambda c: category(c, year)).alias("categories"))
    return F.when(F.size(known) > 0, block)


def codes_from_tags(tags: Column, year: int) -> Column:
    """Codes that tags give for an edition.

    2017 needs its year in the tag; 2021 takes tags with its year, and those that name OWASP without 2017.
    """

    def wanted(tag: Column) -> Column:
        low = F.lower(tag)
        if year == 2017:
            return low.contains("2017")
        return low.contains("2021") | (low.contains("owasp") & ~low.contains("2017"))

    chosen = F.filter(F.coalesce(tags, F.array().cast("array<string>")), wanted)
    numbers = F.flatten(F.transform(chosen, lambda t: F.regexp_extract_all(t, F.lit(r"(?i)\bA([0-9]{1,2})\b"), 1)))
    return F.array_distinct(F.filter(F.transform(numbers, lambda n: _code(n.try_cast("int"), year)), lambda c: c.isNotNull()))


def infer_owasp(case_id: Column, declared: Column | None = None) -> Column:
    """A case's code: as declared with its ground truth, else from owasp<year>-a<nn> in its id, else a bare A<n>."""
    text = F.coalesce(case_id, F.lit(""))
    named = F.regexp_extract(text, r"(?i)owasp[0-9]{4}-a([0-9]{2})", 1).try_cast("int")
    bare = F.regexp_extract(text, r"(?i)\bA([0-9]{1,2})\b", 1).try_cast("int")
    found = F.coalesce(_code(named, 2021), _code(bare, 2021))
    return found if declared is None else F.coalesce(owasp_id(declared), found)
