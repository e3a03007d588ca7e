"""Alignment of sentiment and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewire.functions import dates, ids, labels
from tapewire.operators.as_of import last_before

# The columns of a signal.
SIGNAL_COLUMNS = [
    "id",
    "ticker_id",
    "sentiment_from_yesterday",
    "price_change_in_percentage",
    "match",
    "created_at",
]


def match_prices(
    votes: DataFrame,
    changes: DataFrame,
    report_date: str = "report_date",
    run_col: str | None = None,
    lookback_days: int | None = None,
) -> DataFrame:
    """Join each vote with the price change of the trading day before its report date.

    That is the last weekday before; with ``lookback_days`` the last day that has a price row
    within so many days up to that weekday, so that a holiday takes the day before it.

    Prices landed per run, with their run date in ``run_col``, serve the report of their own
    run only. Both sides hold one row per ticker and day. Spark broadcasts the prices when
    they are small enough and sorts and merges otherwise.
    """
    if run_col and lookback_days:
        raise ValueError("prices landed per run are those of one day")
    run = [F.col(run_col).alias(report_date)] if run_col else []
    prices = changes.select(
        *run,
        F.col("symbol").alias("ticker"),
        F.col("date").alias("_trade_date"),
        "price_change_in_percentage",
        "price_trend",
    )
    keys = ["ticker", "_trade_date", *([report_date] if run_col else [])]
    aligned = votes.withColumn("_trade_date", dates.previous_trading_day(report_date))
    if lookback_days:
        traded = last_before(
            aligned.withColumnRenamed("_trade_date", "_weekday"),
            prices.select("ticker", "_trade_date").distinct(),
            "ticker", "_weekday", "_trade_date", lookback_days,
        )
        aligned = aligned.withColumnRenamed("_trade_date", "_weekday")
        aligned = aligned.join(traded, ["ticker", "_weekday"], "left").drop("_weekday")
    flag = labels.label_to_flag("sentiment")
    return (
        aligned.join(prices, keys, "left")
        .withColumn("sentiment_from_yesterday", flag)
        .withColumn("match", labels.trend_matches("sentiment_from_yesterday", "price_trend"))
        .withColumn("has_price", F.col("price_trend").isNotNull())
        .drop("_trade_date")
    )


def as_signals(matched: DataFrame, report_date: str = "report_date") -> DataFrame:
    """Final signal rows: a stable id per ticker and run, stamped with the run date."""
    return (
        matched.withColumn("id", ids.stable_id("ticker", report_date))
        .withColumn("created_at", dates.run_timestamp(report_date))
        .withColumnRenamed("ticker", "ticker_id")
        .select(*SIGNAL_COLUMNS)
    )
