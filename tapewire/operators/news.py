"""Cleaning of landed ticker and sector news."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tapewire import schemas
from tapewire.constants import TICKER_ALIASES
from tapewire.functions import dates, text
from tapewire.operators.columns import align, project_strict, resolve_alias
from tapewire.operators.dedupe import first_n


def ticker_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalised ticker news with a ticker and some content, before any dedupe."""
    df = resolve_alias(raw, "ticker", TICKER_ALIASES)
    if "date_published" in df.columns:
        df = df.withColumn("date_published", dates.calendar_date("date_published"))
    return (
        align(df, schemas.TICKER_CLEAN, keep)
        .withColumn("ticker", text.normalise_ticker("ticker"))
        .withColumn("content", text.content_or_title("content", "title"))
        .where((F.length("ticker") > 0) & (F.length("content") > 0))
    )


def clean_ticker_news(raw: DataFrame, run_col: str | None = None) -> DataFrame:
    """One row per (ticker, content): the latest published, then the first address and title.

    With ``run_col`` several runs are cleaned at once, each on its own.
    """
    runs = [run_col] if run_col else []
    order = [
        F.col("date_published").desc_nulls_last(),
        F.col("source_url").asc_nulls_last(),
        F.col("title").asc_nulls_last(),
    ]
    return first_n(ticker_rows(raw, runs), [*runs, "ticker", "content"], order)


def complete_articles(df: DataFrame) -> DataFrame:
    """Rows with title, content and address; blank strings count as present."""
    return df.dropna(subset=["title", "content", "source_url"])


def clean_sector_news(
    raw: DataFrame, run_col: str | None = None, first_run_wins: bool = False
) -> DataFrame:
    """One row per address: the latest published, then by the remaining columns.

    With ``run_col`` every run keeps its own row per address; with ``first_run_wins`` the
    earliest run's row is the only one, as an insert-only table would end up with.
    """
    runs = [run_col] if run_col else []
    df = complete_articles(raw).withColumn("source_url", F.trim("source_url"))
    if "date_published" in df.columns:
        df = df.withColumn("date_published", dates.calendar_date("date_published"))
    df = align(df, schemas.SECTOR_CLEAN, runs)
    order = [
        F.col("date_published").desc_nulls_last(),
        *[
            F.col(c).asc_nulls_last()
            for c in ["title", "content", "sector_id", "author", "source_id"]
        ],
    ]
    if first_run_wins:
        keys, order = ["source_url"], [*[F.col(c).asc() for c in runs], *order]
    else:
        keys = [*runs, "source_url"]
    return project_strict(
        first_n(df, keys, order), [*runs, *schemas.SECTOR_CLEAN.fieldNames()]
    )


def publish_window(
    raw: DataFrame, run_date: str | dt.date, published: str = "date_published"
) -> DataFrame:
    """Rows in the news window of a run date, given as a date or as a column name."""
    return raw.where(dates.in_publish_window(published, run_date))


def head_per_sector(
    raw: DataFrame, run_date: str | dt.date, position: str, n: int
) -> DataFrame:
    """The first ``n`` articles of each sector in response order, inside the news window.

    With a run-date column, every run keeps its own ``n``.
    """
    keys = [run_date, "sector_id"] if isinstance(run_date, str) else ["sector_id"]
    return first_n(publish_window(raw, run_date), keys, [F.col(position).asc()], n)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, columns matched by name, absent ones null."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def undated(news: DataFrame, by: str = "ticker", published: str = "date_published") -> DataFrame:
    """(by, n_undated): rows without a publish date, which belong to no report date."""
    rows = news.where(F.col(published).isNull()).groupBy(by)
    return rows.agg(F.count(F.lit(1)).alias("n_undated"))


def on_report_dates(
    news: DataFrame, published: str = "date_published", name: str = "report_date"
) -> DataFrame:
    """Each article once for either report date whose window holds it.

    An equi-join on the report date then replaces a range join on the window. Rows
    without a publish date belong to no report date; ``undated`` counts them.
    """
    # Exploding a null array yields no row; the dates of a null date are null.
    dated = news.where(F.col(published).isNotNull())
    return dated.withColumn(name, F.explode(dates.report_dates(published)))
