"""Lists of cases as users write them: CSV files with or without a header, with comments and blank rows.

All files are read by one plan.  Whether a file has a header is told from its first row, which comes to the other rows of the file by
a join; a header names the cells of a row, and without one their places do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most cells of a row that are read.
CELLS = 32
# The names that make a first row a header, and what the cells of a row without one stand for.
HEADER_NAMES = ("repo_path", "repo_url", "repo_key")
PLACES = ("case_id", "repo_path", "label", "branch", "track", "tags_json")
COLUMNS = ["case_id", "runs_repo_name", "label", "repo_path", "repo_url", "repo_key", "branch", "commit", "track", "tags_json", "sonar_project_key", "aikido_git_ref"]


def safe_name(value: Column) -> Column:
    """A name that can be part of a path: odd characters become single underscores, and it begins with no dot."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(value, F.lit(""))), "[^A-Za-z0-9_.:-]+", "_"), "_+", "_")
    inner = F.regexp_replace(plain, "^_+|_+$", "")
    shown = F.when(~inner.isin(".", ".."), F.regexp_replace(inner, r"^\.+", ""))
    return F.coalesce(F.nullif(shown, F.lit("")), F.lit("unknown"))


def _last_step(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def _key_of_url(url: Column) -> Column:
    """The name of a repository in its URL, as a project key may have it: underscores for other characters, and not of digits alone."""
    name = F.regexp_replace(_last_step(url), r"\.git$", "")
    key = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_.:]+", "_"), "_+", "_"), "^_+|_+$", "")
    return F.when(key.rlike("^[0-9]+$"), F.concat(F.lit("p_"), key)).otherwise(key)


def _tags(text: Column) -> Column:
    """A JSON object as written, in one form; {} for anything else."""
    value = F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))
    return F.coalesce(F.to_json(value), F.lit("{}"))


def cases_of(rows: DataFrame) -> DataFrame:
    """(list, place, COLUMNS) of rows (list, place, cells): one case per row, lists told apart by name, rows in the order of place.

    Rows without any text and rows whose first cell begins with # are left out, and so are rows under a header that name no
    repository.  A missing case id is the last step of the repository's path, or its key, or the name in its URL.
    """
    cells = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    clean = rows.select("list", "place", cells.alias("cells")).where(F.exists("cells", lambda c: c != "") & ~F.get("cells", F.lit(0)).startswith("#"))
    first = clean.groupBy("list").agg(F.min("place").alias("first"), F.min_by("cells", "place").alias("header"))
    header = F.transform("header", lambda c: F.lower(c))
    told = first.select("list", "first", F.when(F.arrays_overlap(header, F.array(*map(F.lit, HEADER_NAMES))), header).alias("header"))
    body = clean.join(told, "list").where(F.col("header").isNull() | (F.col("place") != F.col("first")))
    # of columns with one name the last counts
    by_header = {n: F.get("cells", (F.size("header") - F.nullif(F.array_position(F.reverse("header"), n), F.lit(0))).cast("int")) for n in ("tags", *COLUMNS)}
    alone = F.size("cells") == 1
    by_place = {n: F.when(alone, F.get("cells", F.lit(0)) if n == "repo_path" else None).otherwise(F.get("cells", F.lit(k))) for k, n in enumerate(PLACES)}
    has = F.col("header").isNotNull()

    def cell(name: str) -> Column:
        own = F.when(has, by_header[name])
        found = own.otherwise(by_place[name]) if name in by_place else own
        return F.coalesce(found, F.lit(""))

    named = body.select("list", "place", has.alias("_has"), *[cell(n).alias(n) for n in COLUMNS], F.when(has, by_header["tags"]).alias("_tags"))
    kept = named.where(~F.col("_has") | (F.col("repo_path") != "") | (F.col("repo_url") != "") | (F.col("repo_key") != ""))
    by_path = ~F.col("_has") | (F.col("repo_path") != "")
    fallback = F.when(by_path, _last_step(F.col("repo_path"))).otherwise(F.coalesce(F.nullif("repo_key", F.lit("")), _key_of_url(F.col("repo_url"))))
    case_id = safe_name(F.coalesce(F.nullif("case_id", F.lit("")), fallback))
    runs_name = safe_name(F.when(by_path, case_id).otherwise(F.coalesce(F.nullif("runs_repo_name", F.lit("")), case_id)))
    return kept.select(
        "list", "place", case_id.alias("case_id"), runs_name.alias("runs_repo_name"), F.coalesce(F.nullif("label", F.lit("")), case_id).alias("label"), "repo_path",
        F.when(by_path, "").otherwise(F.col("repo_url")).alias("repo_url"), F.when(by_path, "").otherwise(F.col("repo_key")).alias("repo_key"), "branch", "commit", "track",
        _tags(F.coalesce(F.nullif("_tags", F.lit("")), F.col("tags_json"))).alias("tags_json"), "sonar_project_key", "aikido_git_ref",
    )


def read_case_lists(spark: SparkSession, path: str) -> DataFrame:
    """cases_of() the CSV files at path, a file a list; a row has CELLS cells at most, and empty ones at its end don't count."""
    names = [f"c{k}" for k in range(CELLS)]
    rows = spark.read.option("recursiveFileLookup", True).option("multiLine", True).option("escape", '"').csv(path, schema=", ".join(f"{n} string" for n in names))
    cells = F.array(*names)
    last = F.array_max(F.transform(cells, lambda c, k: F.when(c.isNotNull(), k + 1).otherwise(0)))
    return cases_of(rows.select(F.col("_metadata.file_path").alias("list"), F.monotonically_increasing_id().alias("place"), F.slice(cells, F.lit(1), F.greatest(last, F.lit(1))).alias("cells")))
