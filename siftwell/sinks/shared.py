"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="siftwell-")


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and Spark runs in one process, as in tests, a temporary folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _own_folder()


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out anew if it comes in fewer partitions than there are slots, as a few small files do."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


#: Whether shuffle files go when the plan that wrote them has ended, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """df, written and reread: later plans start at the table, and lost executors cost no earlier work.  Its shuffle files go."""
    spark = df.sparkSession
    path, before = f"{folder(spark)}/siftwell-{uuid.uuid4().hex}", spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
