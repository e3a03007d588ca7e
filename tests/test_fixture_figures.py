"""Figures that FIXTURES.md gives for its own views at scale 0.01."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapewire.functions import urls
from tapewire.operators import news, reliability, votes
from tapewire.operators.quotes import price_changes
from tapewire.operators.reports import kpis
from tapewire.operators.scoring import LexiconScorer, with_labels
from tapewire.operators.signals import match_prices
from tests.conftest import rows

WORDS = ("the", "to", "is", "der", "la"), ("and", "of", "in", "die", "de")


@pytest.fixture(scope="module")
def documents(spark, medium):
    pages = spark.read.parquet(f"{medium}/pages.parquet").select("page_id", "url")
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    key = F.col("doc_id") % pages.count()
    return docs.withColumn("page_id", key).join(pages, "page_id", "left")


def every(n):
    return F.col("doc_id") % n == 0


def dated(extra=None):
    day = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("doc_id") % 30).cast("string"), 2, "0"))
    out = F.when(every(19), "n/a")
    if extra is not None:
        out = out.when(extra, None)
    return out.when(every(5), day).otherwise(F.concat(day, F.lit("T14:00:00Z")))


def nation(number):
    return F.concat(F.lit("NATION_"), number.cast("string"))


def ticker_news(documents):
    name = nation(F.col("doc_id") % 25)
    return documents.select(
        F.when(every(13), None)
        .when(every(7), F.concat(F.lit(" "), F.lower(name), F.lit(" ")))
        .otherwise(name)
        .alias("ticker"),
        F.when(every(11), None).when(every(17), "").otherwise(F.col("text")).alias("content"),
        F.substring("text", 1, 60).alias("title"),
        dated().alias("date_published"),
        F.col("url").alias("source_url"),
    )


def sector_news(documents):
    url = F.col("url")
    return documents.select(
        (1 + F.col("doc_id") % 5).cast("int").alias("sector_id"),
        F.when(~every(29), F.substring("text", 1, 60)).alias("title"),
        F.when(~every(11), F.col("text")).alias("content"),
        dated(every(31)).alias("date_published"),
        F.when(every(23), None)
        .when(every(9), F.concat(F.lit("  "), url, F.lit(" ")))
        .otherwise(url)
        .alias("source_url"),
        F.when(~every(10), F.col("source")).alias("author"),
        F.col("source").alias("source_name"),
    )


@pytest.fixture(scope="module")
def quotes(spark, medium):
    events = spark.read.parquet(f"{medium}/events.parquet")
    return events.groupBy(
        nation(F.col("user_id") % 25).alias("symbol"), F.to_date("ts").alias("date")
    ).agg(F.min_by("value", "event_id").alias("open"), F.max_by("value", "event_id").alias("close"))


def plain_news(documents):
    return documents.select(
        nation(F.col("doc_id") % 25).alias("ticker"),
        F.col("text").alias("content"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date_published"),
    )


def test_cleaned_feeds(documents):
    assert news.clean_ticker_news(ticker_news(documents)).count() == 922
    assert news.clean_sector_news(sector_news(documents)).count() == 250
    window = news.publish_window(sector_news(documents), dt.date(2024, 1, 10))
    assert window.count() == 329


def test_labels_and_one_day(documents, quotes):
    scorer = LexiconScorer(*WORDS, max_chars=2000)
    labelled = with_labels(plain_news(documents), scorer)
    counts = dict(rows(labelled.groupBy("label").count()))
    assert counts == {"positive": 570, "negative": 338, "neutral": 92}
    voted = votes.majority_vote(labelled).withColumn(
        "report_date", F.lit("2024-01-06").cast("date")
    )
    matched = match_prices(voted, price_changes(quotes))
    got = matched.groupBy("sentiment_from_yesterday", "match").count()
    assert sorted(rows(got)) == [(False, True, 1), (True, False, 7), (True, True, 17)]


def test_panel_over_all_report_dates(documents, quotes):
    scorer = LexiconScorer(*WORDS, max_chars=4000)
    labelled = news.on_report_dates(with_labels(plain_news(documents), scorer))
    voted = votes.majority_vote(labelled, ["ticker", "report_date"])
    matched = match_prices(voted, price_changes(quotes))
    got = matched.groupBy("sentiment_from_yesterday", "match", ~F.col("has_price")).count()
    assert sorted(rows(got)) == [
        (False, False, False, 26),
        (False, False, True, 1),
        (False, True, False, 27),
        (True, False, False, 123),
        (True, False, True, 4),
        (True, True, False, 119),
    ]
    flags = matched.withColumn("sentiment_from_yesterday", F.lit("Positive"))
    assert kpis(flags, ["report_date"]).count() == 31


def test_ratings_and_domains(spark, medium):
    pages = spark.read.parquet(f"{medium}/pages.parquet")
    hosts = pages.groupBy(urls.host("url").alias("source_id")).agg(F.min("page_id").alias("pid"))
    pid = F.col("pid")
    as_of = F.lit("2024-02-01").cast("date")
    observed = hosts.select(
        "source_id",
        F.when(pid % 7 == 0, None).when(pid % 7 == 1, 404).when(pid % 7 == 2, 403).otherwise(200)
        .cast("int").alias("status_code"),
        ((pid % 60) / 10).alias("elapsed_s"),
        F.when(pid % 5 != 0, F.date_sub(as_of, (pid * 137).cast("int"))).alias("creation_date"),
        ((pid % 21 - 10) / 10).alias("polarity"),
        (pid * 61 % 2600).cast("int").alias("text_chars"),
        F.lit(False).alias("ugc_page"),
    )
    scores = reliability.source_scores(reliability.source_features(observed, "2024-02-01"))
    rated = reliability.rate_sources(scores, "2024-02-01")
    assert dict(rows(reliability.rating_distribution(rated))) == {"A": 11, "B": 47}
    more = spark.createDataFrame([("news.bbc.co.uk",), ("www.mom.gov.sg",)], "source_id string")
    every_host = hosts.select("source_id").union(more)
    named = every_host.select(urls.registered_domain("source_id").alias("d"), "source_id")
    assert named.count() == 60
    assert {r.d for r in named.select("d").distinct().collect()} >= {"bbc.co.uk", "mom.gov.sg"}
