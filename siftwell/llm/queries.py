"""The registered queries of this subpackage and, where SQL expresses them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import audit, bytepair, decontamination, fingerprints, infill, jaccard, licenses, personal, pieces, quality, secrets, substrings, token_counts
from siftwell.llm.shared import small_batches


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_documents(spark, sf_dir))
    spans = F.transform("licences", lambda s: F.concat_ws(":", s["family"], s["start"].cast("string"), s["end"].cast("string")))
    families = F.array_sort(F.array_distinct(F.transform("licences", lambda s: s["family"])))
    return found.select("doc_id", F.size("licences").cast("bigint").alias("n_licences"), F.array_join(families, ",").alias("families"), F.array_join(spans, ",").alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_pairs(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fp")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


OP8_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), pairs AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM docs WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), versions AS (
  SELECT doc_id, 'own' AS kind, text FROM pairs
  UNION ALL SELECT doc_id, 'next', next_text FROM pairs
  UNION ALL SELECT doc_id, 'edited', substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) FROM pairs
), hashed AS (
  SELECT *, list_transform(string_split(text, chr(10)), lambda p: md5(p) || md5('+' || p)) AS digests,
    list_transform(list_filter(string_split_regex(text, '[.!?,;|' || chr(10) || ']+'), lambda s: s <> ''), lambda s: CAST('0x' || substr(md5(s), 1, 15) AS BIGINT)) AS hashes
  FROM versions
), lanes AS (
  SELECT doc_id, kind, text, CAST(len(hashes) AS BIGINT) AS n,
    list_transform(range(6), lambda k: list_sum(list_transform(digests, lambda d: CAST('0x' || substr(d, CAST(k * 10 + 1 AS INT), 10) AS BIGINT))) % 1099511627776) AS wide,
    list_transform(range(60), lambda k: coalesce(list_sum(list_transform(hashes, lambda h: (h >> k) & 1)), 0) % 65536) AS sketch
  FROM hashed
), texts AS (
  SELECT *, array_to_string(list_transform(wide, lambda x: printf('%010X', CAST(x AS BIGINT))), '') || printf('%08X', n)
    || array_to_string(list_transform(sketch, lambda x: printf('%04X', CAST(x AS BIGINT))), '') AS fp
  FROM lanes
), signs AS (
  SELECT *, list_transform(sketch, lambda x: 2 * x - n) AS signed FROM texts
), squared AS (
  SELECT *, list_sum(list_transform(signed, lambda x: x * x)) AS own_squares FROM signs
), likes AS (
  SELECT a.doc_id, a.text, a.fp, b.kind, b.text AS other_text, b.fp AS other_fp,
    CASE WHEN a.n + b.n = 0 THEN 1.0::DOUBLE
      WHEN a.own_squares + b.own_squares = 0 THEN 0.0::DOUBLE
      ELSE greatest(0.0::DOUBLE, CAST(2 * list_sum(list_transform(range(60), lambda k: a.signed[k + 1] * b.signed[k + 1])) AS DOUBLE) / CAST(a.own_squares + b.own_squares AS DOUBLE)) END AS likeness
  FROM squared a JOIN squared b ON a.doc_id = b.doc_id AND a.kind = 'own' AND b.kind <> 'own'
)
SELECT doc_id, CAST(length(any_value(text)) AS BIGINT) AS n_chars,
  sha256(max(other_text) FILTER (kind = 'edited')) AS edited_sha256, any_value(fp) AS fingerprint,
  max(other_fp) FILTER (kind = 'edited') AS edited_fingerprint,
  max(likeness) FILTER (kind = 'edited') AS near_edited, max(likeness) FILTER (kind = 'next') AS near_next
FROM likes GROUP BY doc_id
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _digests(found: DataFrame, base: Column, kinds: list[str]) -> DataFrame:
    """The count of each kind of base spans, the hash of all base spans, and all spans."""
    rows = found.select("doc_id", base.alias("base"), "spans")
    named = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(named, lambda k: k == kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]  # noqa: B023
    return rows.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir))
    return _digests(found, F.filter("spans", lambda s: s["kind"].isin(secrets.BASE_KINDS)), secrets.BASE_KINDS)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(_documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT r, doc_id, p, array_to_string(words[p:p + 12], ' ') AS body FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs WHERE doc_id IS NOT NULL)
), covered AS (
  SELECT DISTINCT r, p + k AS place FROM (SELECT r, doc_id, p, min(doc_id) OVER (PARTITION BY body) AS least FROM windows), range(0, 13) AS t(k) WHERE least < doc_id
), gone AS (
  SELECT r, list(place) AS places FROM covered GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda w, k: NOT list_contains(coalesce(places, []), k)), ' ')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = quality.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(_documents(spark, sf_dir))


OP4_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[p:p + 4], ' ') END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS p FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM docs
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, lowest AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT id AS doc_id, min(other) AS lowest FROM reach GROUP BY id) USING (doc_id)
"""


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = pieces.round_trip(_documents(spark, sf_dir).select("doc_id", "text"), model)
    return both.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(personal.find(_documents(spark, sf_dir)), F.col("base"), personal.BASE_KINDS)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(audit.masks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP11_SQL = """
WITH RECURSIVE labelled AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda w: w <> '') AS words
  FROM documents
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM docs LEFT JOIN labelled USING (doc_id)
), failed AS (
  SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM judged
), kinds AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS t(f) WHERE NOT contains(o, f)
), steps AS (
  SELECT o AS filter_order, CAST(k AS INTEGER) AS step, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) AS r(k) WHERE length(o) = 5
), met AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS bad, fails = f AS sole,
    length(translate(fails, before, '')) < length(fails) AS gone
  FROM kinds, steps
), counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bad AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN sole THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bad AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN bad AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


def op12_bytepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bytepair.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = infill.transform(_documents(spark, sf_dir))
    text = infill.restored(F.col("output"), F.col("form"))
    return cuts.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), drawn AS (
  SELECT doc_id, text, n, list_transform(range(4), lambda k: CAST('0x' || substr(digest, CAST(8 * k + 1 AS INT), 8) AS BIGINT)) AS h FROM docs
), cuts AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cuts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_substrings": op2_substrings,
    "op3_quality": op3_quality,
    "op4_jaccard": op4_jaccard,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_licenses": op6_licenses,
    "op7_decontamination": op7_decontamination,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_personal": op10_personal,
    "op11_filter_audit": op11_filter_audit,
    "op12_bytepair": op12_bytepair,
    "op13_infill": op13_infill,
}

ORACLE_SQL: dict[str, str] = {
    "op2_substrings": OP2_SQL,
    "op4_jaccard": OP4_SQL,
    "op8_fingerprints": OP8_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_infill": OP13_SQL,
}
