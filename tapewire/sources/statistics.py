"""Answers from the footers of stored Parquet files, without reading a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapewire import schemas
from tapewire.session import side_session

# Aggregates reach the footers through the newer Parquet source only.
FOOTERS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def stored_date_bounds(spark: SparkSession, signals: str, articles: str) -> DataFrame:
    """First and last day over the stored signals and articles, as ``reports.date_bounds`` has
    them, from the partitions' names and the files' statistics.

    ``signals`` lie by run date, the day of ``created_at``, and ``articles`` by the month of
    publication. Their numbers of files bound the work. Undated rows, which lie in a
    partition of their own, count for nothing; empty tables give nulls. A day that is no part
    of a file's statistics, as very old writers leave it out, is an error of Spark's.

    The result belongs to a session of its own, whose settings the caller's does not share.
    """
    side = side_session(spark, FOOTERS)
    runs = side.read.schema(schemas.with_run_date(schemas.TICKER_ARTICLE)).parquet(signals)
    # Grouping by the partition keeps a count, which a footer holds, in place of its rows.
    days = runs.groupBy("run_date").agg(F.count(F.lit(1)).alias("n"))
    month = T.StructField(schemas.PUBLISHED_MONTH, T.DateType())
    stored = side.read.schema(T.StructType([*schemas.SECTOR_ARTICLE.fields, month])).parquet(articles)
    dated = stored.where(F.col(schemas.PUBLISHED_MONTH).isNotNull())
    ends = dated.agg(F.min("date_published").alias("low"), F.max("date_published").alias("high"))
    both = days.where("n > 0").select(
        F.col("run_date").alias("low"), F.col("run_date").alias("high")
    ).unionByName(ends)
    return both.agg(F.min("low").alias("min_date"), F.max("high").alias("max_date"))
