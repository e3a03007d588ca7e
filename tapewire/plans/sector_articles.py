"""Sector news to scored articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire import schemas
from tapewire.functions import dates, ids, urls
from tapewire.operators.columns import align, project_strict
from tapewire.operators.news import clean_sector_news, complete_articles
from tapewire.operators.scoring import Scorer, with_impact
from tapewire.sinks.keyed import KeyedTable

FINAL_COLUMNS = [*schemas.SECTOR_CLEAN.fieldNames(), "impact_score"]


def score_articles(clean: DataFrame, scorer: Scorer, run_col: str | None = None) -> DataFrame:
    """Curated sector news with impact scores and the source key taken from the address."""
    rows = complete_articles(clean).withColumn(
        "date_published", dates.calendar_date("date_published")
    )
    scored = (
        with_impact(rows, scorer)
        .withColumn("source_id", urls.source_id("source_url"))
        .drop("source_name")
    )
    return project_strict(scored, [*([run_col] if run_col else []), *FINAL_COLUMNS])


def sector_articles(raw: DataFrame, scorer: Scorer, run_col: str = "run_date") -> DataFrame:
    """The article table after all runs: the first run to see an address keeps it."""
    clean = clean_sector_news(raw, run_col, first_run_wins=True)
    return as_sector_articles(score_articles(clean, scorer, run_col), run_col)


def as_sector_articles(scored: DataFrame, run_col: str) -> DataFrame:
    stamped = scored.withColumn("created_at", dates.run_timestamp(run_col)).withColumn(
        "sector_article_id", ids.stable_id("source_url")
    )
    return align(stamped, schemas.SECTOR_ARTICLE)


def article_table(spark: SparkSession, path: str, buckets: int | None = None) -> KeyedTable:
    """The stored articles, by month of publication and in buckets of the address."""
    month = (schemas.PUBLISHED_MONTH, F.trunc("date_published", "month"))
    return KeyedTable(spark, path, schemas.SECTOR_ARTICLE, ["source_url"], buckets, month)
