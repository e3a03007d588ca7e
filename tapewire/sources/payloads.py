"""Landed API responses to article rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewire import schemas


def parse_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON text to the response struct, in a column ``response``."""
    return payloads.withColumn(
        "response", F.from_json(F.col(payload), schemas.NEWS_PAYLOAD)
    ).drop(payload)


def _articles(payloads: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Exploding no array gives no row, so failed and empty responses drop out without a
    filter. A filter would be pushed below the parsing and parse every payload again."""
    articles = F.when(F.col("response.status") == "ok", F.col("response.articles"))
    parsed = parse_payloads(payloads, payload)
    return parsed.select(*keep, F.posexplode(articles).alias("position", "a"))


def flatten_ticker_payloads(
    payloads: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("ticker",)
) -> DataFrame:
    """One row per article of a ticker's response, missing fields null."""
    return _articles(payloads, payload, list(keep)).select(
        F.col("a.source.id").alias("source_id"),
        F.col("a.source.name").alias("source_name"),
        F.col("a.title").alias("title"),
        F.col("a.content").alias("content"),
        F.col("a.publishedAt").alias("date_published"),
        F.col("a.url").alias("source_url"),
        "position",
        *keep,
    )


def flatten_sector_payloads(
    payloads: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("sector_id",)
) -> DataFrame:
    """One row per article of a sector's response, in response order by ``position``."""
    return _articles(payloads, payload, list(keep)).select(
        "position",
        F.col("a.title").alias("title"),
        F.col("a.content").alias("content"),
        F.col("a.publishedAt").alias("date_published"),
        F.col("a.url").alias("source_url"),
        F.col("a.author").alias("author"),
        F.col("a.source.name").alias("source_name"),
        *keep,
    )


def payload_outcomes(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """How many responses were used, failed, or came back empty."""
    ok = F.col("response.status") == "ok"
    some = F.size("response.articles") > 0
    outcome = F.when(ok & some, "used").when(ok, "empty").otherwise("error")
    return (
        parse_payloads(payloads, payload)
        .groupBy(outcome.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n_payloads"))
    )
