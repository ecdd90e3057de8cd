"""Five stages that clean the documents table: what a stage keeps is written as Parquet, and the next one reads it.

The stages keep the columns of documents, further ones included, but for the last, which has pieces in place of the text.
Stages that compare rows know them by a hash of id and text, so rows with a null or repeated id are judged like any other.
A null text counts as empty; an empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import decontamination, jaccard, pieces, quality, secrets
from siftwell.llm.shared import Tables, delete, folder, only, small_batches, without

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is LEAST_QUALITY or more."""
    small_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, score_col="quality score").where(F.col("quality score") >= LEAST_QUALITY).drop("quality score")


#: A hash of a row's id and text, of 64 bits.  The Jaccard stage never takes rows that share it by chance for one; decontamination judges them alike.
ROW_KEY = "siftwell row key"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW_KEY, F.xxhash64(F.col("doc_id").cast("string"), F.lit("|"), "text"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, or of the smallest key of equal ids.

    A null id counts as the largest.  Of rows that are equal in all columns, one stays.
    """
    tables, keyed = Tables(small_batches(spark)), _keyed(docs)
    groups = jaccard.linked_components(keyed, id_col=ROW_KEY)
    named = groups.join(keyed.select(ROW_KEY, "doc_id"), ROW_KEY)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW_KEY)
    many = groups.where(F.col(ROW_KEY) != F.col("component_id")).select("component_id").distinct()
    first = named.join(many, "component_id", "left_semi").groupBy("component_id").agg(F.min(rank).alias("first"))
    later = named.join(first, "component_id").where(F.col(ROW_KEY) != F.col(f"first.{ROW_KEY}")).select(F.col(ROW_KEY).alias("id"))
    kept = without(tables, keyed, later, ROW_KEY)
    twice = tables.put(groups.groupBy(ROW_KEY).count().where("count > 1").select(F.col(ROW_KEY).alias("id")))
    again = only(tables, kept, twice, ROW_KEY).drop(ROW_KEY).dropDuplicates()
    return without(tables, kept, twice, ROW_KEY).drop(ROW_KEY).unionByName(again)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    small_batches(spark)
    found = decontamination.leaks(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW_KEY)
    return without(Tables(spark), _keyed(docs), found.select(F.col(ROW_KEY).alias("id")), ROW_KEY).drop(ROW_KEY)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind; n_chars is counted anew where it changes."""
    small_batches(spark)
    return secrets.redact(docs, n_chars_col="n_chars")


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces in place of the text: n_pieces, piece_ids, and lossless, whether decoding gives back the text."""
    small_batches(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = pieces.round_trip(docs, model)
    lossless = F.col("decoded") == F.coalesce("text", F.lit(""))
    return both.withColumns({"n_pieces": F.size("piece_ids"), "lossless": lossless}).drop("text", "decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("sentencepiece encoding", sentencepiece_encoding),
]

#: A trained classifier and sampled segmentations are no SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Each stage's rows are written to the shared folder and read again; those of earlier stages go."""
    root = f"{folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        path = f"{root}/{k}"
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if k:
            delete(spark, f"{root}/{k - 1}")
    return docs
