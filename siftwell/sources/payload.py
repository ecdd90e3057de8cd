"""Report payloads of unknown shape, as VARIANT values that are walked to their scalars.

No schema says beforehand where a scanner puts CWE ids, OWASP codes or tags.  So a payload is kept whole, and each round of
the walk opens all objects and arrays that the one before has found, until only scalars are left.  A scalar has its trail
(the keys on the way, outermost first) and its places (its positions in the arrays on the way); rules on trails then say what
it stands for.  A round is one plan over all payloads: there are as many as the deepest payload has levels.

Objects hold their keys in order of the alphabet.  A null payload, an empty one and text that is no JSON have no scalars.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.sinks.shared import stored

#: Between the keys of a trail that is matched as one text.
STEP = "\x1f"


def leaves(rows: DataFrame, ids: list[str], payloads: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """(ids, root, trail, places, kind, text) of each scalar of the named payloads that isn't null.

    ids are columns that tell the rows apart; root is the name of the payload.  keys: the outermost keys that are walked, all
    by default.  kind is the scalar's type in SQL.
    """
    roots = F.explode(F.array(*[F.struct(F.lit(name).alias("root"), value.alias("value")) for name, value in payloads.items()]))
    whole = rows.select(*ids, roots.alias("_")).select(*ids, "_.root", "_.value").where("value IS NOT NULL")
    none = [F.array().cast("array<string>").alias("trail"), F.array().cast("array<int>").alias("places")]
    if keys is None:
        level = whole.select(*ids, "root", *none, "value")
    else:
        under = F.explode(F.array(*[F.struct(F.array(F.lit(k)).alias("trail"), F.try_variant_get("value", f'$["{k}"]', "variant").alias("value")) for k in keys]))
        level = whole.select(*ids, "root", none[1], under.alias("_")).select(*ids, "root", "_.trail", "places", "_.value").where("value IS NOT NULL")
    spark, found = rows.sparkSession, []
    while True:
        level = stored(level.withColumn("kind", F.schema_of_variant("value")))
        opens = F.col("kind").rlike("^(OBJECT|ARRAY)<")
        found.append(level.where(~opens & (F.col("kind") != "VOID")).select(*ids, "root", "trail", "places", "kind", F.try_variant_get("value", "$", "string").alias("text")))
        inner = level.where(opens)
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, found)
        opened = spark.tvf.variant_explode(F.col("value").outer()).select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_value"))
        trail = F.when(F.col("_key").isNull(), F.col("trail")).otherwise(F.array_append("trail", F.col("_key")))
        places = F.when(F.col("_key").isNull(), F.array_append("places", F.col("_pos"))).otherwise(F.col("places"))
        level = inner.lateralJoin(opened).select(*ids, "root", trail.alias("trail"), places.alias("places"), F.col("_value").alias("value"))


Rules = list[str]


def _rank(rules: Rules) -> Column:
    """The place of the first rule that the whole trail matches; null for none."""
    at = F.array_join(F.concat(F.array("root"), "trail"), STEP)
    pattern = [rf"^(?:{rule.replace('/', STEP)})\z" for rule in rules]
    return F.coalesce(*[F.when(at.rlike(p), k) for k, p in enumerate(pattern)], F.lit(None).cast("int"))


def texts_by_role(scalars: DataFrame, ids: list[str], roles: dict[str, Rules], only_texts: tuple[str, ...] = ()) -> DataFrame:
    """(ids, one list of texts per role): the scalars whose trail one of the role's rules matches, by rule, then by places, then by trail.

    A rule is a regular expression of root and keys with / between them.  The roles of only_texts leave numbers and truth
    values out.  Texts are trimmed, and blank ones left out; a row without any scalar of some role has no row here.
    """
    text = F.trim("text")
    ranks = {r: F.when((F.col("kind") == "STRING") | F.lit(r not in only_texts), _rank(rules)) for r, rules in roles.items()}
    ranked = scalars.where(text != "").select(*ids, "trail", "places", text.alias("text"), *[c.alias(f"_{r}") for r, c in ranks.items()])
    entries = {r: F.when(F.col(f"_{r}").isNotNull(), F.struct(F.col(f"_{r}").alias("rank"), "places", "trail", "text")) for r in roles}
    listed = ranked.where(reduce(Column.__or__, [F.col(f"_{r}").isNotNull() for r in roles])).groupBy(*ids).agg(*[F.array_sort(F.collect_list(e)).alias(r) for r, e in entries.items()])
    return listed.select(*ids, *[F.transform(r, lambda e: e["text"]).alias(r) for r in roles])


# The keys under which reports put CWE ids, in the order in which they count; then those of a weakness.
CWE_KEYS = ("cwe", "cwe_id", "cwe_ids", "cweIds", "cwe_classes", "cweClasses", "cwe_class", "cweClass")
WEAKNESS_KEYS = ("cwe", "cwe_id", "cweId", "id", "name")
# The keys of OWASP codes of 2021, alone and within an owasp object, and those that wrap a code.
OWASP_KEYS = ("owasp_top_10_2021", "owasp_2021", "owaspTop10_2021", "owaspTop10")
OWASP_INNER = ("2021", "owasp_top_10_2021", "top_10_2021")
WRAPPERS = ("codes", "code", "id", "name", "category", "owasp")
# The keys of texts that may name ids and codes.
TEXT_KEYS = ("title", "summary", "description", "message", "rule")
# The keys of tags, of every tool and of one.
TAG_KEYS = ("tags", "labels", "categories", "category")
TOOL_TAG_KEYS = {
    "aikido": ("type", "subtype", "language", "rule_id", "rule", "attack_surface", "programming_language", "cve_id", "affected_package"),
    "semgrep": ("check_id", "message", "extra/category", "extra/subcategory", "extra/technology", "extra/confidence", "metadata/category", "metadata/subcategory", "metadata/technology", "metadata/confidence"),
    "snyk": ("ruleId", "rule_id", "name", "shortDescription", "help", "message"),
}


def roles_of(tool: str | None = None, root: str = "payload") -> dict[str, Rules]:
    """Rules for a payload: cwe_fields, weakness_fields, cwe_texts, owasp_fields, owasp_texts and tags."""
    wrapped = rf"(?:/(?:{'|'.join(WRAPPERS)}))*"
    inner = "|".join(OWASP_INNER)
    tags = [*TAG_KEYS, *TOOL_TAG_KEYS.get(tool or "", ()), "title", "summary", "description", "message"]
    return {
        "cwe_fields": [f"{root}/{k}" for k in CWE_KEYS],
        "weakness_fields": [rf"{root}/weaknesses(?:/(?:{'|'.join(WEAKNESS_KEYS)}))?"],
        "weakness_field": [rf"{root}/weakness(?:/(?:{'|'.join(WEAKNESS_KEYS)}))?"],
        "cwe_texts": [f"{root}/{k}(?:/.*)?" for k in (*TEXT_KEYS, "help")],
        "owasp_fields": [*[f"{root}/{k}{wrapped}" for k in OWASP_KEYS], *[f"{root}/owasp/{k}{wrapped}" for k in inner.split("|")]],
        "owasp_texts": [f"{root}/{k}(?:/.*)?" for k in TEXT_KEYS],
        "tags": [f"{root}/{k}" for k in tags],
    }


#: Roles that take texts alone.
TEXT_ROLES = ("cwe_texts", "owasp_texts", "tags")
#: The outermost keys that any role of a payload looks at.
WALKED = sorted({*CWE_KEYS, "weaknesses", "weakness", "owasp", *OWASP_KEYS, *TEXT_KEYS, "help", *TAG_KEYS, *(k.split("/")[0] for keys in TOOL_TAG_KEYS.values() for k in keys)})
