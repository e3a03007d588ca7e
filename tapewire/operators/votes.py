"""Majority vote of article labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tapewire.constants import VOTE_TICKER_ALIASES
from tapewire.operators.columns import resolve_alias


def vote_counts(labelled: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Articles, voting articles and the votes per group. Only two labels vote.

    Plain counts, so Spark adds them up before the shuffle and no group is ever gathered.
    """
    positive, negative = F.col("label") == "positive", F.col("label") == "negative"
    return labelled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.count_if(positive | negative).alias("n_valid"),
        F.count_if(positive).alias("n_positive"),
        F.count_if(negative).alias("n_negative"),
    )


def majority_vote(labelled: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Per group ``positive`` unless the negatives outnumber the positives.

    A tie, and a group without a valid article, are positive.
    """
    ticker_first = resolve_alias(labelled, "ticker", VOTE_TICKER_ALIASES, on_missing="error")
    verdict = F.when(F.col("n_negative") > F.col("n_positive"), "negative").otherwise("positive")
    return vote_counts(ticker_first, by).withColumn("sentiment", verdict)


def distinct_texts(labelled: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and text, so that copies of an article vote once.

    The label depends on the text alone and may join the key. Copies collapse inside each
    map task before anything is shuffled.
    """
    return labelled.select(*by, "text_key", "label").distinct()
