"""The four tables of the daily report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tapewire import schemas
from tapewire.constants import TOP_ARTICLES_DEFAULT
from tapewire.functions import dates
from tapewire.operators import reports
from tapewire.operators.dedupe import latest_per_key


@dataclass(frozen=True)
class DailyReport:
    kpis: DataFrame
    summary: DataFrame
    detail: DataFrame
    top_articles: DataFrame


def daily_report(
    signals: DataFrame,
    articles: DataFrame,
    tickers: DataFrame,
    sectors: DataFrame,
    report_date: str | dt.date,
    sector_names: Sequence[str] | None = None,
    ticker_ids: Sequence[str] | None = None,
    sentiments: Sequence[str] | None = None,
    detail_ticker: str | None = None,
    n: int = TOP_ARTICLES_DEFAULT,
) -> DailyReport:
    """Report of one date.

    Without a selection every row with a known sector, ticker and sentiment is shown; an
    empty selection filters nothing. The sentiment selection narrows the summary but not
    the indicators. Articles are those published the day before.

    Day and ticker filters reach the scan, of stored tables also the partitions, and the latest
    row per ticker is picked before the dimensions are joined: a ticker has one sector, so
    the sector filter may follow.
    """
    # The stored tables are partitioned by run date, which is the date of creation, and by
    # month of publication.
    if "run_date" in signals.columns:
        signals = signals.where(F.col("run_date") == dates.date_lit(report_date))
    day = reports.on_day(signals, "created_at", report_date)
    day = reports.select_in(day, "ticker_id", ticker_ids)
    latest = latest_per_key(day, "ticker_id", id_col="ticker_article_id")
    view = reports.signals_view(latest, tickers, sectors)
    view = reports.select_in(view, "sector_name", sector_names)

    before = F.date_sub(dates.date_lit(report_date), 1)
    if schemas.PUBLISHED_MONTH in articles.columns:
        articles = articles.where(F.col(schemas.PUBLISHED_MONTH) == F.trunc(before, "month"))
    published = articles.where(F.col("date_published") == before)
    shown = reports.select_in(
        reports.articles_view(published, sectors), "sector_name", sector_names
    )
    return DailyReport(
        kpis=reports.kpis(view),
        summary=reports.ticker_summary(view, sentiments),
        detail=reports.ticker_detail(view, detail_ticker),
        top_articles=reports.top_articles(shown, n),
    )
