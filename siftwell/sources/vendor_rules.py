"""What a vendor's rules stand for, from mapping files of three shapes, and findings joined with them by rule id or name.

A file may have rules by language ({"languages": {language: {name: info}}}), rules by key ({key: codes or info}) and a list of
rules ({"rules": [info with id and name]}).  All of them become one table of keys: a rule's id, its name, and its name in
small letters with single spaces.  Of entries with one key the last counts: lists of rules after keys, keys after languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of a file that are no rules, and of what an entry holds, the first that isn't empty counts.
RESERVED = ("_meta", "aliases", "languages", "rules")
OWASP_KEYS = {"languages": ("owasp_top_10_2021", "owasp_2021", "owasp2021"), "others": ("owasp_2021", "owasp_top_10_2021", "owasp2021")}
CWE_KEYS = ("cwe_ids", "cwe", "cweIds")
_LANGUAGES, _KEYS, _RULES = range(3)


def plain_name(name: Column) -> Column:
    """A name in small letters, with single spaces for runs of space and underscores."""
    return F.trim(F.regexp_replace(F.lower(F.replace(name, F.lit("_"), F.lit(" "))), r"\s+", " "))


def _listed(info: Column, keys: tuple[str, ...]) -> Column:
    """The texts under the first of the keys that has any: one text, or the scalars of a list."""

    def under(key: str) -> Column:
        one, many = F.try_variant_get(info, f"$.{key}", "string"), F.try_variant_get(info, f"$.{key}", "array<string>")
        found = F.when(many.isNotNull(), F.array_compact(many)).when(one != "", F.array(one))
        return F.when(F.size(found) > 0, found)

    return F.coalesce(*map(under, keys), F.array().cast("array<string>"))


def rule_index(files: DataFrame) -> DataFrame:
    """(rule_key, owasp_codes, cwe_ids) of files (priority, value): of the files with the lowest priority that has any rule, as of the first file that can be used.

    value is the text of a file; text that is no JSON object holds no rules.
    """
    spark = files.sparkSession
    whole = files.select("priority", F.try_parse_json("value").alias("file"))

    def opened(rows: DataFrame, value: Column, *keep: str | Column) -> DataFrame:
        # keys and values of an object, positions and values of a list
        return rows.select(*keep, value.alias("_whole")).lateralJoin(spark.tvf.variant_explode(F.col("_whole").outer())).drop("_whole")

    languages = opened(whole, F.try_variant_get("file", "$.languages", "variant"), "priority").where("key IS NOT NULL").select("priority", F.col("key").alias("language"), F.col("value").alias("of_language"))
    by_language = opened(languages, F.col("of_language"), "priority", "language").where("key IS NOT NULL")
    by_language = by_language.where(F.trim("key") != "").select("priority", F.struct(F.lit(_LANGUAGES).alias("shape"), F.lit(0).alias("pos"), F.concat_ws("\x1f", "language", "key").alias("at")).alias("order"), F.lit(None).cast("string").alias("id"), F.col("key").alias("name"), "value")
    top = opened(whole, F.col("file"), "priority").where(F.col("key").isNotNull() & ~F.col("key").isin(*RESERVED))
    name = F.try_variant_get("value", "$.name", "string")
    is_list = F.schema_of_variant("value").startswith("ARRAY")
    by_key = top.select("priority", F.struct(F.lit(_KEYS).alias("shape"), F.lit(0).alias("pos"), F.col("key").alias("at")).alias("order"), F.col("key").alias("id"), name.alias("name"), "value", is_list.alias("codes_only"))
    listed = opened(whole, F.try_variant_get("file", "$.rules", "variant"), "priority").where("key IS NULL")
    rule_id = F.coalesce(F.nullif(F.try_variant_get("value", "$.id", "string"), F.lit("")), F.try_variant_get("value", "$.rule_id", "string"))
    by_rule = listed.select("priority", F.struct(F.lit(_RULES).alias("shape"), "pos", F.lit("").alias("at")).alias("order"), F.trim(rule_id).alias("id"), F.trim(name).alias("name"), "value")

    def entries(rows: DataFrame, owasp: tuple[str, ...], keys: list[Column]) -> DataFrame:
        codes = _listed(F.col("value"), owasp)
        if "codes_only" in rows.columns:
            codes = F.when(F.col("codes_only"), F.array_compact(F.coalesce(F.try_variant_get("value", "$", "array<string>"), F.array().cast("array<string>")))).otherwise(codes)
        return rows.select("priority", "order", F.explode(F.array_compact(F.array(*keys))).alias("rule_key"), codes.alias("owasp_codes"), _listed(F.col("value"), CWE_KEYS).alias("cwe_ids"))

    others = OWASP_KEYS["others"]
    every = entries(by_language, OWASP_KEYS["languages"], [F.col("name"), plain_name(F.col("name"))])
    every = every.unionByName(entries(by_key, others, [F.col("id"), plain_name(F.col("name"))])).unionByName(entries(by_rule, others, [F.col("id"), F.col("name"), plain_name(F.col("name"))]))
    used = every.where((F.col("rule_key") != "") & (F.size("owasp_codes") + F.size("cwe_ids") > 0))
    last = used.groupBy("priority", "rule_key").agg(F.max_by(F.struct("owasp_codes", "cwe_ids"), "order").alias("info"))
    first = last.agg(F.min("priority").alias("priority"))
    return last.join(first, "priority").select("rule_key", "info.*")


def read_vendor_rules(spark: SparkSession, paths: list[str]) -> DataFrame:
    """rule_index() of mapping files, which are tried in the order of paths; a path that leads nowhere is passed over."""
    files = None
    for k, path in enumerate(paths):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            one = spark.read.text(path, wholetext=True).select(F.lit(k).alias("priority"), "value")
            files = one if files is None else files.unionByName(one)
    return rule_index(files if files is not None else spark.createDataFrame([], "priority int, value string"))


def with_vendor_rules(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """findings (rule_id, rule_name) with rule_owasp_codes and rule_cwe_ids, empty for rules that the index lacks.

    A finding's rule is looked up by its id, else by its name, else by its plain name.  Rules repeat from finding to finding, so
    the index meets each pair of id and name once, under three keys of which the best is taken.
    """
    pair = ["rule_id", "rule_name"]
    tried = F.array(F.col("rule_id"), F.col("rule_name"), plain_name(F.col("rule_name")))
    keys = findings.select(*pair).distinct().select(*pair, F.posexplode(tried).alias("rank", "rule_key")).where("rule_key <> ''")
    best = keys.join(rules, "rule_key").groupBy(*pair).agg(F.min_by(F.struct("owasp_codes", "cwe_ids"), "rank").alias("info"))
    known = best.select(F.col("rule_id").alias("_id"), F.col("rule_name").alias("_name"), F.col("info.owasp_codes").alias("rule_owasp_codes"), F.col("info.cwe_ids").alias("rule_cwe_ids"))
    rows = findings.join(known, F.col("rule_id").eqNullSafe(F.col("_id")) & F.col("rule_name").eqNullSafe(F.col("_name")), "left").drop("_id", "_name")
    return rows.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("rule_owasp_codes", "rule_cwe_ids")})
