"""From responses and price history to the landed feeds, for one run date or many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tapewire import schemas
from tapewire.functions import dates
from tapewire.operators.columns import align
from tapewire.operators.news import head_per_sector, publish_window
from tapewire.operators.quotes import for_universe
from tapewire.sinks import writers
from tapewire.sources.payloads import flatten_sector_payloads, flatten_ticker_payloads


def sector_feed(
    payloads: DataFrame, n: int, run_col: str = "run_date", order: Sequence[str] = ("position",)
) -> DataFrame:
    """What a run lands for its sectors: of each, the first ``n`` articles in the news window.

    ``payloads``: sector_id, the run date, the response, and whatever else ``order`` names
    where a sector has several responses.
    """
    keep = ["sector_id", run_col, *[c for c in order if c != "position"]]
    rows = flatten_sector_payloads(payloads, keep=tuple(keep))
    placed = rows.withColumn("_place", F.struct(*order))
    head = head_per_sector(placed, run_col, "_place", n)
    return align(head, schemas.RAW_SECTOR_NEWS, [run_col])


def ticker_feed(payloads: DataFrame, run_col: str = "run_date") -> DataFrame:
    """What a run lands for its tickers (ticker, run date, response): all in the news window."""
    rows = flatten_ticker_payloads(payloads, keep=("ticker", run_col))
    return align(publish_window(rows, run_col), schemas.RAW_TICKER_NEWS, [run_col])


def market_feed(
    quotes: DataFrame, tickers: DataFrame, runs: DataFrame, run_col: str = "run_date"
) -> DataFrame:
    """What each run (one row of ``runs``) lands: known tickers' prices of the last trading day."""
    wanted = runs.select(run_col, dates.previous_trading_day(run_col).alias("date")).distinct()
    known = for_universe(quotes, tickers)
    return align(known.join(wanted, "date"), schemas.MARKET_OHLC, [run_col])


def land(feed: DataFrame, path: str, run_col: str = "run_date") -> int:
    """A feed as JSON lines under ``path/date=…/``, which replace those of its run dates.

    A partition column would clash with a date of the feed's own, as prices have, so the
    lines of such a feed are made first. Either way one write serves all run dates.
    """
    if "date" not in feed.columns:
        by_day = feed.withColumnRenamed(run_col, "date")
        return writers.write_partitioned(by_day, path, "date", "json")
    row = F.struct(*[c for c in feed.columns if c != run_col])
    line = F.to_json(row, {"ignoreNullFields": "false"}).alias("value")
    return writers.write_partitioned(feed.select(line, F.col(run_col).alias("date")), path, "date", "text")
