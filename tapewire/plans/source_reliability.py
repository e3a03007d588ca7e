"""Ratings of the sources that articles come from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tapewire.operators.reliability import distinct_sources, rate_known_and_unprobed


def rate_article_sources(
    articles: DataFrame, probe: DataFrame, as_of: str | dt.date, exact_trust: bool = False
) -> DataFrame:
    if "source_url" not in articles.columns:
        raise ValueError("articles have no source_url column")
    return rate_known_and_unprobed(distinct_sources(articles), probe, as_of, exact_trust)
