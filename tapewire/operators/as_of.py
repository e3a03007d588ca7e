"""Backward as-of join: for each key and day, the last row of a history up to that day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Days of a slice as a multiple of the look-back.
SLICE = 4


def _slices(day: Column, days: int, lookback: int) -> Column:
    """The slice of a day of the history, and the next one where its look-back reaches it."""
    number = F.unix_date(day)
    here = F.floor(number / days)
    reaches = number + lookback > (here + 1) * days
    return F.when(reaches, F.array(here, here + 1)).otherwise(F.array(here))


def last_before(
    wanted: DataFrame, history: DataFrame, key: str, day: str, at: str, lookback_days: int
) -> DataFrame:
    """Each distinct (key, day) of ``wanted`` with the row of ``history`` (key, at, ...) whose
    date ``at`` is the last one in the ``lookback_days`` days up to ``day``.

    Pairs without such a row, and null keys and dates, are left out. Of several rows with one
    date the greatest by the other columns counts; clashing names in ``history`` are not allowed.

    No join: both sides go into one window, in which the last row seen is kept. The window
    belongs to a key and a slice of days, so that a key with a long history is spread over many
    tasks; rows near the end of a slice are copied into the next. Repeated pairs collapse
    before the shuffle.
    """
    days = SLICE * lookback_days
    others = [c for c in history.columns if c not in (key, at)]
    pairs = wanted.select(key, day).where(F.col(key).isNotNull() & F.col(day).isNotNull())
    asked = pairs.distinct().select(
        key, F.floor(F.unix_date(day) / days).alias("_slice"), F.col(day).alias("_day"),
        F.lit(1).alias("_asks"),
    )
    known = history.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key,
        F.explode(_slices(F.col(at), days, lookback_days)).alias("_slice"),
        F.col(at).alias("_day"),
        F.lit(0).alias("_asks"),
        F.struct(at, *others).alias("_row"),
    )
    both = known.unionByName(asked, allowMissingColumns=True)
    order = ["_day", "_asks", *[F.col("_row").getField(c) for c in others]]
    so_far = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    last = F.last("_row", ignorenulls=True).over(so_far)
    found = both.withColumn("_last", last).where("_asks = 1")
    recent = found.where(F.col("_last").getField(at) > F.date_sub("_day", lookback_days))
    return recent.select(key, F.col("_day").alias(day), *_fields("_last", [at, *others], day))


def _fields(struct: str, names: Sequence[str], taken: str) -> list[Column]:
    return [F.col(struct).getField(n).alias(n) for n in names if n != taken]
