"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Bytes of rows that Spark hands to a Python worker at a time.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound batches for Python workers by their size, for texts of any length.

    A session setting, since Spark reads it when the query runs.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


class Scratch:
    """Tables of one run, in a folder of its own. A table is written once and then read.

    Reading a written table costs no lineage: a lost executor makes Spark read the files
    again, not compute them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df``, from files."""
        path = self.path(name)
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch_path = path
        return saved

    def drop(self, *saved: DataFrame) -> None:
        """Delete tables that nothing will read any more."""
        jvm = self.spark._jvm
        for df in saved:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            files.delete(path, True)
