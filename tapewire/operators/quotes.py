"""Daily prices: one row per symbol and day, lookups, and change columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tapewire import schemas
from tapewire.functions import dates, market
from tapewire.operators.as_of import last_before
from tapewire.operators.columns import align, lower_columns
from tapewire.operators.dedupe import first_n

PRICES = ["open", "high", "low", "close"]


def clean_quotes(
    raw: DataFrame, run_col: str | None = None, per_run: bool = False
) -> DataFrame:
    """One quote per (symbol, date), column names in any letter case; prices that are NaN or
    infinite become null.

    Runs on Saturday, Sunday and Monday all land Friday's row; the latest run wins, or with
    ``per_run`` every run keeps its own.
    """
    df = lower_columns(raw)
    runs = [run_col] if run_col else []
    df = align(df, schemas.MARKET_OHLC, runs)
    df = df.withColumns({c: market.finite(c) for c in PRICES})
    order = [F.col(c).desc_nulls_last() for c in [*runs, *reversed(PRICES)]]
    if per_run:
        return first_n(df, [*runs, "symbol", "date"], order)
    return first_n(df, ["symbol", "date"], order).drop(*runs)


def price_changes(quotes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return quotes.select(
        *keep,
        "symbol",
        "date",
        market.price_change_pct("open", "close").alias("price_change_in_percentage"),
        market.price_trend("open", "close").alias("price_trend"),
    )


def quote_on_date(history: DataFrame, day: str | dt.date, ts: str = "ts") -> DataFrame:
    """The first row of each symbol on one day, read as the range [day, day + 1)."""
    rows = history.where(dates.on_date(ts, day))
    first = F.min(F.struct(F.col(ts), *PRICES)).alias("_quote")
    prices = [F.col("_quote").getField(c).alias(c) for c in PRICES]
    return (
        rows.groupBy("symbol")
        .agg(first)
        .select("symbol", dates.date_lit(day).alias("date"), *prices)
    )


def latest_quote(quotes: DataFrame, as_of: str | dt.date, lookback_days: int) -> DataFrame:
    """The last quote of each symbol in the days up to ``as_of``, none if all are older."""
    d = dates.date_lit(as_of)
    recent = quotes.where((F.col("date") > F.date_sub(d, lookback_days)) & (F.col("date") <= d))
    last = F.max(F.struct("date", *PRICES)).alias("_quote")
    fields = [F.col("_quote").getField(c).alias(c) for c in ["date", *PRICES]]
    return recent.groupBy("symbol").agg(last).select("symbol", *fields)


def quotes_as_of(
    wanted: DataFrame, quotes: DataFrame, lookback_days: int, day: str = "day"
) -> DataFrame:
    """(symbol, day, date, prices): for each distinct symbol and day of ``wanted`` the last quote
    in the days up to it, as over a weekend or a holiday; none if all are older."""
    history = quotes.select("symbol", "date", *PRICES)
    return last_before(wanted, history, "symbol", day, "date", lookback_days)


def for_universe(quotes: DataFrame, tickers: DataFrame) -> DataFrame:
    """Quotes of the known tickers; symbols without a quote are simply absent."""
    symbols = tickers.select(F.col("ticker_id").alias("symbol"))
    return quotes.join(symbols, "symbol", "left_semi")
