"""DataFrames to files. Every writer returns the number of rows it wrote.

The count is observed during the write itself and costs no further job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import (
    Column,
    DataFrame,
    DataFrameWriter,
    Observation,
    SparkSession,
    functions as F,
    types as T,
)

from tapewire.operators.columns import align
from tapewire.operators.upsert import new_rows


def _save(writer_of, df: DataFrame, path: str, fmt: str) -> int:
    seen = Observation()
    writer: DataFrameWriter = writer_of(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    writer.format(fmt).save(path)
    return seen.get["rows"]


def write_partitioned(
    df: DataFrame, path: str, partition_by: str, fmt: str = "parquet"
) -> int:
    """Replace the partitions that occur in ``df`` and leave all others alone.

    Running a day again therefore replaces that day. Rows are rebalanced by partition value
    first: small days share a task, and a day with most of the rows is split over many.
    """
    ready = spread_by(df, partition_by)

    def writer(rows: DataFrame) -> DataFrameWriter:
        return (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", "false")
            .partitionBy(partition_by)
        )

    return _save(writer, ready, path, fmt)


def spread_by(df: DataFrame, partition_by: str) -> DataFrame:
    return df.hint("rebalance", F.col(partition_by))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write one table; an empty one keeps its schema in Parquet. CSV gets a header."""
    options = {"header": True, "escape": '"'} if fmt == "csv" else {}
    return _save(lambda rows: rows.write.mode(mode).options(**options), df, path, fmt)


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None
) -> None:
    """An empty Parquet table, unless there is a table already.

    A partitioned one has no file until rows come, so read it by its schema.
    """
    empty = spark.createDataFrame([], schema)
    if partition_by is None:
        empty.write.mode("ignore").parquet(path)
    else:
        keyed = empty.withColumn(partition_by, F.lit(None).cast("date"))
        keyed.write.mode("ignore").partitionBy(partition_by).parquet(path)


def insert_new(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
) -> int:
    """Insert-only merge into a Parquet table: appends the rows whose keys are new.

    The table is read by its key columns and never rewritten.
    """
    target = spark.read.schema(schema).parquet(path)
    return append_rows(align(new_rows(target, batch, keys, order), schema), path)


def append_rows(rows: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Append to a table in few files: small inserts leave one a partition, large ones are
    spread."""
    if partition_by is None:
        return write_table(rows.hint("rebalance"), path, mode="append")
    return _save(
        lambda df: df.write.mode("append").partitionBy(partition_by),
        spread_by(rows, partition_by),
        path,
        "parquet",
    )


def write_merged(merged: DataFrame, target_path: str, new_path: str) -> int:
    """Write a merge result beside the table it was read from, never over it."""
    if target_path.rstrip("/") == new_path.rstrip("/"):
        raise ValueError("a merge result must go to a new path")
    return write_table(merged, new_path)
