"""Findings that arrive as files: the tables of the cases they belong to are made anew, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CASE = ["suite_id", "case_id"]


def refresh_cases(spark: SparkSession, incoming: str, store: str, out: str, schema: str, make: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Stream Parquet findings from incoming to store, and write make(findings) of every touched case to out.

    Both tables are partitioned by suite and case, and only touched partitions are overwritten.  A batch that is run
    again replaces its own part of the store (batch = its number), so a failure leaves no findings twice.
    """

    def process(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CASE, "batch").parquet(store)
        stored = spark.read.schema(f"{schema}, batch long").parquet(store).drop("batch")
        touched = stored.join(F.broadcast(batch.select(*CASE).distinct()), CASE, "left_semi")
        make(touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CASE).parquet(out)

    source = spark.readStream.schema(schema).parquet(incoming)
    return source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
