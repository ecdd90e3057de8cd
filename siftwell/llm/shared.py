"""Intermediate tables in the folder that driver and executors share, and connected components on them."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


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


#: Bytes of the batches that Spark hands to Python: a task holds a few of them at once.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """spark, whose Arrow batches hold at most BATCH_BYTES from here on, whatever the length of the rows; smaller settings stay."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([bkmg]?)b?", spark.conf.get(name).lower())
    size = int(now[1]) << {"k": 10, "m": 20, "g": 30}.get(now[2], 0) if now else 0
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever Spark can write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Tables:
    """Tables that are written once and read again; last() removes all but the result."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{folder(spark)}/siftwell-{uuid.uuid4().hex}"
        self._n = 0

    def put(self, df: DataFrame) -> DataFrame:
        """df, written and reread: its lineage ends here, and lost executors cost no earlier work."""
        path = f"{self.root}/{self._n}"
        self._n += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def last(self, df: DataFrame) -> DataFrame:
        """df, written and reread as put() does, after which the other tables go."""
        found = self.put(df)
        for k in range(self._n - 1):
            delete(self.spark, f"{self.root}/{k}")
        return found


#: Ids that are sent to every task at most: 16 MB.
MOST_SENT = 1 << 20


def without(tables: Tables, df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of df whose id is not among ids (id).  Few ids, by their count, go to every task; else both sides are shuffled."""
    found = tables.put(ids.select(F.col("id").alias(id_col)).distinct())
    few = found.limit(MOST_SENT + 1).count() <= MOST_SENT
    return df.join(F.broadcast(found) if few else found, id_col, "left_anti")


def only(tables: Tables, df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows of df whose id is among ids (id); few ids go to every task, so that other rows aren't shuffled."""
    found = tables.put(ids.select(F.col("id").alias(id_col)).distinct())
    few = found.limit(MOST_SENT + 1).count() <= MOST_SENT
    return df.join(F.broadcast(found) if few else found, id_col, "left_semi")


def components(tables: Tables, edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges (a, b): the smallest id that its edges lead to.

    Each round takes the smallest label of the neighbours and then the label of the label, so
    that long chains shorten by half; a hub's edges meet in joins that Spark can split.
    """
    edges = edges.where("a <> b")
    both = tables.put(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = tables.put(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        low = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("next"))
        found = tables.put(low.join(jump, "low").select("id", "old", F.col("next").alias("component")))
        labels = found.select("id", "component")
        if found.where("old <> component").isEmpty():
            return labels
