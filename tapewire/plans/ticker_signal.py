"""News sentiment per ticker against the price move of the previous trading day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewire.operators.news import on_report_dates, ticker_rows
from tapewire.operators.quotes import price_changes
from tapewire.operators.scoring import Scorer, text_labels
from tapewire.operators.signals import as_signals, match_prices
from tapewire.operators.votes import distinct_texts, majority_vote


def ticker_votes(raw_news: DataFrame, scorer: Scorer, run_col: str | None = None) -> DataFrame:
    """One vote per ticker and report date, copies of a text counted once.

    News landed per run carries its report date in ``run_col``. Without one, each article
    belongs to the two report dates whose window holds its publish date. Texts are scored
    before they are doubled, and only their keys are shuffled.
    """
    day = run_col or "date_published"
    rows = ticker_rows(raw_news, [run_col] if run_col else [])
    labelled = text_labels(rows, scorer, ["ticker", day])
    if run_col:
        dated = labelled.withColumn("report_date", F.col(run_col))
    else:
        dated = on_report_dates(labelled)
    by = ["ticker", "report_date"]
    return majority_vote(distinct_texts(dated, by), by)


def matched_votes(
    raw_news: DataFrame,
    quotes: DataFrame,
    scorer: Scorer,
    run_col: str | None = None,
    lookback_days: int | None = None,
) -> DataFrame:
    """Votes with their price change, the match flag, and whether a price was found.

    Quotes that carry ``run_col`` as well are matched within their own run; others may be older
    by ``lookback_days``, for holidays.
    """
    landed = run_col if run_col in quotes.columns else None
    changes = price_changes(quotes, [landed] if landed else [])
    votes = ticker_votes(raw_news, scorer, run_col)
    return match_prices(votes, changes, run_col=landed, lookback_days=lookback_days)


def ticker_signals(
    raw_news: DataFrame, quotes: DataFrame, scorer: Scorer, run_col: str | None = None
) -> DataFrame:
    return as_signals(matched_votes(raw_news, quotes, scorer, run_col))
