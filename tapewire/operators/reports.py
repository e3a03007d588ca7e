"""Report queries over signals and scored sector articles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapewire.constants import TOP_ARTICLES_DEFAULT
from tapewire.functions import dates, labels, text
from tapewire.operators.columns import project_lenient
from tapewire.operators.dedupe import first_n

DETAIL_COLUMNS = {
    "stock_ticker": "ticker",
    "sentiment_from_yesterday": "sentiment",
    "price_change_in_percentage": "price_change",
    "match": "matched",
    "created_at": "created_at",
}


def signals_view(signals: DataFrame, tickers: DataFrame, sectors: DataFrame) -> DataFrame:
    """Signals with their sector name and a display label; unknown tickers stay in.

    The dimensions carry no hint: Spark broadcasts them below its size threshold and
    sorts and merges above it.
    """
    return (
        signals.join(tickers, "ticker_id", "left")
        .join(sectors, "sector_id", "left")
        .select(
            "ticker_article_id",
            F.col("ticker_id").alias("stock_ticker"),
            labels.flag_to_label("sentiment_from_yesterday").alias("sentiment_from_yesterday"),
            "price_change_in_percentage",
            "match",
            "created_at",
            "sector_name",
        )
    )


def newest_signals(df: DataFrame) -> DataFrame:
    """Newest first, undated rows before all others."""
    return df.orderBy(F.col("created_at").desc_nulls_first(), F.col("ticker_article_id").asc())


def recent_signals(
    signals: DataFrame, tickers: DataFrame, sectors: DataFrame, n: int | None = None
) -> DataFrame:
    """The newest ``n`` signals with their sector, or all of them.

    The rows are picked before the dimensions are joined, which neither adds nor drops any.
    """
    if n is None:
        return newest_signals(signals_view(signals, tickers, sectors))
    picked = newest_signals(signals).limit(n)
    return newest_signals(signals_view(picked, tickers, sectors)).limit(n)


def articles_view(articles: DataFrame, sectors: DataFrame) -> DataFrame:
    """Scored sector articles with their sector name."""
    return (
        articles.where(F.col("impact_score").isNotNull())
        .join(sectors, "sector_id", "left")
        .select(
            "sector_article_id",
            "title",
            "content",
            "impact_score",
            "date_published",
            "source_url",
            "created_at",
            "sector_name",
        )
    )


def newest_articles(view: DataFrame) -> DataFrame:
    """By publish date, newest first. The id follows, so that one busy day still splits
    over many sort ranges."""
    return view.orderBy(
        F.col("date_published").desc_nulls_first(), F.col("sector_article_id").asc()
    )


def select_in(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows with one of the values. An empty selection filters nothing.

    No selection at all stands for every option being chosen, and options are never null.
    """
    if values is None:
        return df.where(F.col(column).isNotNull())
    return df.where(F.col(column).isin(list(values))) if values else df


def on_day(df: DataFrame, ts: str, day: str | dt.date | None) -> DataFrame:
    return df if day is None else df.where(dates.on_date(ts, day))


def kpis(view: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Mean sentiment, mean price change, tickers and negatives, with the means' signs."""
    score = labels.label_to_score("sentiment_from_yesterday")
    measured = view.groupBy(*by).agg(
        F.avg(score).alias("avg_sentiment"),
        F.avg("price_change_in_percentage").alias("avg_price_change"),
        F.count(F.lit(1)).alias("n_tickers"),
        F.count_if(F.col("sentiment_from_yesterday") == "Negative").alias("n_negative"),
    )
    return measured.withColumns(
        {
            "sentiment_sign": labels.sign_bucket("avg_sentiment"),
            "price_sign": labels.sign_bucket("avg_price_change"),
        }
    )


def ticker_summary(
    view: DataFrame,
    sentiments: Sequence[str] | None = None,
    by: Sequence[Column | str] = ("stock_ticker",),
) -> DataFrame:
    """Signals, mean sentiment and mean price change per ticker, in ticker order."""
    shown = select_in(view, "sentiment_from_yesterday", sentiments)
    score = labels.label_to_score("sentiment_from_yesterday")
    return (
        shown.groupBy(*by)
        .agg(
            F.count("ticker_article_id").alias("article_count"),
            F.avg(score).alias("avg_sentiment"),
            F.avg("price_change_in_percentage").alias("avg_price_change"),
        )
        .orderBy("stock_ticker")
    )


def ticker_detail(view: DataFrame, ticker: str | None = None) -> DataFrame:
    """The signals behind a ticker's summary row, for display; no ticker shows all."""
    rows = view if ticker is None else view.where(F.col("stock_ticker") == ticker)
    if "created_at" in rows.columns:
        rows = rows.withColumn("created_at", dates.format_minute("created_at"))
    shown, _ = project_lenient(rows, list(DETAIL_COLUMNS))
    return shown.withColumnsRenamed(DETAIL_COLUMNS)


def impact_order() -> list[Column]:
    """Strongest first, then newest, then by id."""
    return [
        F.col("impact_score").desc_nulls_last(),
        F.col("date_published").desc_nulls_last(),
        F.col("sector_article_id").asc(),
    ]


def top_articles(view: DataFrame, n: int = TOP_ARTICLES_DEFAULT) -> DataFrame:
    check_top_n(n)
    return article_display(view.orderBy(*impact_order()).limit(n))


def top_articles_by_day(
    articles: DataFrame, sectors: DataFrame, n: int = TOP_ARTICLES_DEFAULT
) -> DataFrame:
    """The top articles of every report date at once; each shows the day before.

    Articles are picked before they are joined with their sectors.
    """
    check_top_n(n)
    scored = articles.where(
        F.col("impact_score").isNotNull() & F.col("date_published").isNotNull()
    )
    picked = articles_view(first_n(scored, ["date_published"], impact_order(), n), sectors)
    dated = picked.withColumn("report_date", F.date_add("date_published", 1))
    return article_display(dated, ["report_date"])


def check_top_n(n: int) -> None:
    if n < 1:
        raise ValueError("n must be at least 1")


def article_display(view: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return view.select(
        *keep,
        text.article_link("source_url", "title").alias("article"),
        F.col("impact_score").alias("impact"),
        F.col("sector_name").alias("sector"),
        dates.format_day("date_published").alias("published"),
    )


def date_bounds(signals: DataFrame, articles: DataFrame) -> DataFrame:
    """First and last day over both tables, each reduced to its own bounds first."""
    days = signals.select(F.to_date("created_at").alias("day")).unionByName(
        articles.select(F.col("date_published").cast("date").alias("day"))
    )
    return days.agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))


def options(df: DataFrame, column: str, name: str = "option") -> DataFrame:
    """Distinct values of a column in order, nulls left out."""
    return (
        df.select(F.col(column).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
        .orderBy(name)
    )


def sector_options(signals: DataFrame, articles: DataFrame) -> DataFrame:
    """Sector names of the signals, or those of the articles where there is no signal."""
    preferred = signals.select("sector_name")
    fallback = articles.where(~signals.select(F.lit(1)).exists()).select("sector_name")
    return options(preferred.unionByName(fallback), "sector_name")
