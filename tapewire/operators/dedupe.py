"""First rows per key, with a full ordering so that reruns pick the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    The rank filter lets Spark limit every group before the shuffle, so a map task sends
    at most ``n`` rows of a key however often it occurs. A hash of the key leads the
    partitioning, so that sorting compares a long before it compares long texts; the key
    itself follows, so no two keys can merge.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def latest_per_day(
    signals: DataFrame, key: str = "ticker_id", ts: str = "created_at", id_col: str = "id"
) -> DataFrame:
    """The latest row per key and calendar day; ties go to the highest id."""
    day = signals.withColumn("_day", F.to_date(ts))
    order = [F.col(ts).desc(), F.col(id_col).desc()]
    return first_n(day, [key, "_day"], order).drop("_day")


def latest_per_key(
    signals: DataFrame, key: str = "ticker_id", ts: str = "created_at", id_col: str = "id"
) -> DataFrame:
    return first_n(signals, [key], [F.col(ts).desc_nulls_last(), F.col(id_col).desc()])
