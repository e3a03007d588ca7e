"""Landed files to warehouse tables, for one run date or for a backlog of them.

Curated tables are written before anything reads them, so each later step starts from
files rather than from a long lineage, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire import schemas
from tapewire.constants import SECTOR_TICKERS
from tapewire.functions import dates
from tapewire.operators.columns import align, require_non_empty
from tapewire.operators.news import clean_sector_news, clean_ticker_news
from tapewire.operators.quality import article_counters
from tapewire.operators.quotes import clean_quotes
from tapewire.operators.reliability import rate_from_first_run
from tapewire.operators.scoring import Scorer
from tapewire.plans.sector_articles import article_table, as_sector_articles, score_articles
from tapewire.plans.ticker_signal import ticker_signals
from tapewire.sinks import writers
from tapewire.sinks.keyed import KeyedTable
from tapewire.sources import dimensions
from tapewire.sources.readers import bad_lines, read_landing, read_parquet

RUN, BAD = "run_date", "_bad_line"
TABLES = {
    "sectors": schemas.SECTORS,
    "tickers": schemas.TICKERS,
    "sources": schemas.SOURCES,
    "sector_article": schemas.SECTOR_ARTICLE,
}


def create_warehouse(
    spark: SparkSession,
    root: str,
    mapping: Mapping[str, Sequence[str]] = SECTOR_TICKERS,
    buckets: int | None = None,
) -> None:
    """Create missing tables and insert missing dimension rows.

    ``buckets``: of the tables that grow, articles and sources.
    """
    for name in ("sectors", "tickers"):
        writers.create_table(spark, f"{root}/{name}", TABLES[name])
    source_table(spark, root, buckets)
    article_table(spark, f"{root}/sector_article", buckets)
    lists = dimensions.sector_lists(spark, mapping)
    sectors = lists.select("sector_id", "sector_name")
    by_id = [F.col("sector_id").asc()]
    writers.insert_new(
        spark, f"{root}/sectors", schemas.SECTORS, sectors, ["sector_name"], by_id
    )
    known = read_parquet(spark, f"{root}/sectors", schemas.SECTORS)
    listed = lists.select("sector_name", F.explode("symbols").alias("ticker_id"))
    tickers = listed.join(known, "sector_name").select("ticker_id", "sector_id")
    writers.insert_new(spark, f"{root}/tickers", schemas.TICKERS, tickers, ["ticker_id"], by_id)


def source_table(spark: SparkSession, root: str, buckets: int | None = None) -> KeyedTable:
    return KeyedTable(spark, f"{root}/sources", schemas.SOURCES, ["source_id"], buckets)


def run_day(
    spark: SparkSession,
    landing: str,
    curated: str,
    warehouse: str,
    probe: DataFrame,
    run_date: str | dt.date,
    vote_scorer: Scorer,
    impact_scorer: Scorer,
) -> dict[str, int]:
    return run_days(
        spark, landing, curated, warehouse, probe, [run_date], vote_scorer, impact_scorer
    )


def run_days(
    spark: SparkSession,
    landing: str,
    curated: str,
    warehouse: str,
    probe: DataFrame,
    run_dates: Sequence[str | dt.date],
    vote_scorer: Scorer,
    impact_scorer: Scorer,
) -> dict[str, int]:
    """Process the run dates together and return counts by name.

    These are the rows written per table, and what was not: lines that are no JSON, raw
    sector articles read, incomplete and repeated, articles of unknown sectors and tickers
    without a row in their dimension, whose articles and signals are refused.

    The outcome is that of running the dates one after another. Running them again replaces
    their curated rows and signals, inserts no source or article twice, and rates or scores
    none that is stored.
    """
    rows = {}

    def write_runs(table: str, root: str, df: DataFrame) -> None:
        rows[table] = writers.write_partitioned(df, f"{root}/{table}", RUN)

    def read_runs(table: str, schema) -> DataFrame:
        df = read_parquet(spark, f"{curated}/{table}", schemas.with_run_date(schema))
        return df.where(F.col(RUN).isin([dates.date_lit(d) for d in run_dates]))

    def stored(table: str) -> DataFrame:
        return read_parquet(spark, f"{warehouse}/{table}", TABLES[table])

    def land(kind: str, schema) -> DataFrame:
        return read_landing(spark, f"{landing}/{kind}", schema, run_dates, RUN, bad_col=BAD)

    quotes = land("market", schemas.MARKET_OHLC)
    require_non_empty(
        quotes.where("symbol is not null"), f"market landing of {', '.join(map(str, run_dates))}"
    )
    raw_ticker = land("news/ticker", schemas.RAW_TICKER_NEWS)
    raw_sector = land("news/sector", schemas.RAW_SECTOR_NEWS)
    write_runs("ticker_clean", curated, clean_ticker_news(raw_ticker, RUN))
    write_runs("sector_clean", curated, clean_sector_news(raw_sector, RUN))

    # A signal needs a known ticker, so news of others is not scored.
    ticker_news = read_runs("ticker_clean", schemas.TICKER_CLEAN)
    tickers = stored("tickers").select(F.col("ticker_id").alias("ticker"))
    known_news = ticker_news.join(tickers, "ticker", "left_semi")
    landed_quotes = clean_quotes(quotes, RUN, per_run=True)
    signals = ticker_signals(known_news, landed_quotes, vote_scorer, RUN)
    table = align(signals.withColumnRenamed("id", "ticker_article_id"), schemas.TICKER_ARTICLE)
    write_runs("ticker_article", warehouse, table.withColumn(RUN, F.to_date("created_at")))

    sector_news = read_runs("sector_clean", schemas.SECTOR_CLEAN)
    # Sources go in before the articles that refer to them.
    sources = source_table(spark, warehouse)
    rows["sources"] = sources.append(
        rate_from_first_run(sector_news, probe, RUN, known=sources.read())
    )
    # The first run to see an address keeps it. Stored addresses and articles of unknown
    # sectors go before anything is scored.
    sectors = stored("sectors").select("sector_id", F.lit(True).alias("_known"))
    placed = sector_news.join(sectors, "sector_id", "left")
    refused = F.col("sector_id").isNotNull() & F.col("_known").isNull()
    accepted = placed.where(~refused).drop("_known")
    articles = article_table(spark, f"{warehouse}/sector_article")
    fresh = articles.new_rows(accepted, [F.col(RUN).asc()])
    rows["sector_article"] = articles.append(
        as_sector_articles(score_articles(fresh, impact_scorer, RUN), RUN)
    )

    rows["articles_of_unknown_sector"] = placed.where(refused).count()
    unknown = ticker_news.join(tickers, "ticker", "left_anti")
    rows["signals_of_unknown_ticker"] = unknown.select("ticker", RUN).distinct().count()
    readable = raw_sector.where(F.col(BAD).isNull())
    counters = article_counters(readable, sector_news, "source_url").first()
    for name in ("rows_in", "rows_dropped", "duplicates_removed"):
        rows[f"sector_{name}"] = counters[name]
    rows["bad_lines"] = sum(
        bad_lines(df, BAD) for df in (quotes, raw_ticker, raw_sector)
    )
    return rows
