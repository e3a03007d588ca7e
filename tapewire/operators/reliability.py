"""Reliability of news sources from landed probe observations.

A probe row holds what one visit to a source returned. A missing row, or a null field,
means that the visit or that part of it failed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapewire.constants import (
    COMMERCIAL_ENDINGS,
    COMPOUND_SUFFIXES,
    FEATURE_WEIGHTS,
    INSTITUTION_ENDINGS,
    REACHABLE_STATUS,
    TRUSTED_SOURCES,
    UGC_PHRASES,
    UGC_SITES,
)
from tapewire.functions import dates, urls
from tapewire.functions.market import finite
from tapewire.functions.text import col
from tapewire.operators.upsert import absent

# Scales of the features.
MAX_ELAPSED_S = 5
FULL_AGE_DAYS = 9125
TEXT_LENGTHS = (300, 2000)
SHORT_TEXT_VALUE = 0.8
NEUTRALITY_FLOOR = 0.7
COMMERCIAL_AGE_FLOOR = 0.9
TRUST_BONUS = 15
INSTITUTION_BONUS = 10
SCORE_FLOOR = 85
FLOOR_MIN_AGE, FLOOR_MAX_UGC = 0.8, 0.5
RATING_A_FROM, RATING_B_ABOVE = 86, 55


def clamp_scale(value: Column | str, low: float | Column, high: float | Column) -> Column:
    """Scale to [0, 1] between two bounds, clamped; null and NaN count as 0."""
    lo, hi = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    scaled = (col(value).cast("double") - lo) / (hi - lo)
    # greatest and least pass over nulls and rank NaN above all, so both go before them.
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))
    return F.when(col(value).isNull() | F.isnan(scaled), 0.0).otherwise(clamped)


def distinct_sources(articles: DataFrame, url: str = "source_url") -> DataFrame:
    """The hosts of all articles, once each; empty ones are left out."""
    hosts = articles.select(urls.source_id(url).alias("source_id"))
    return hosts.where(F.col("source_id").isNotNull()).distinct()


def summarise_probe(probe: DataFrame) -> DataFrame:
    """What scoring needs from an observation. Pages and texts stay out of every shuffle."""
    page = F.lower("html")
    phrases = [p.lower() for p in UGC_PHRASES]
    return probe.select(
        "source_id",
        "status_code",
        finite("elapsed_s").alias("elapsed_s"),
        "creation_date",
        finite("polarity").alias("polarity"),
        F.length("article_text").alias("text_chars"),
        urls.contains_any(page, phrases).alias("ugc_page"),
    )


def source_features(
    observed: DataFrame,
    as_of: str | dt.date | Column,
    suffixes: Sequence[str] = COMPOUND_SUFFIXES,
) -> DataFrame:
    """The eight features of each summarised observation, and its registered domain."""
    df = observed.withColumn("registered", urls.registered_domain("source_id", suffixes))
    address = F.concat(F.lit("https://"), F.col("source_id"))
    reached = F.col("status_code").isNotNull()
    status = F.when(F.col("status_code").isin(REACHABLE_STATUS), 1.0).otherwise(0.5)
    left = F.lit(float(MAX_ELAPSED_S)) - F.col("elapsed_s")

    known = F.datediff(dates.date_lit(as_of), F.col("creation_date"))
    days = F.greatest(F.coalesce(known, F.lit(0)), F.lit(0))
    age = clamp_scale(F.log1p(days), 0, F.log1p(F.lit(float(FULL_AGE_DAYS))))
    institution = urls.ends_with_any("registered", INSTITUTION_ENDINGS)
    commercial = urls.ends_with_any("registered", COMMERCIAL_ENDINGS)
    aged = (
        F.when(institution, 1.0)
        .when(commercial, F.greatest(age, F.lit(COMMERCIAL_AGE_FLOOR)))
        .otherwise(age)
    )

    unread = (
        F.col("text_chars").isNull()
        | F.col("polarity").isNull()
        | (F.col("text_chars") < TEXT_LENGTHS[0])
    )
    neutral = F.greatest(F.lit(NEUTRALITY_FLOOR), 1 - F.abs("polarity"))
    length = clamp_scale("text_chars", *TEXT_LENGTHS)

    known_ugc = F.when(urls.contains_any(address, UGC_SITES), 0.7).otherwise(0.0)
    page_ugc = F.when(reached & F.coalesce(F.col("ugc_page"), F.lit(False)), 0.3).otherwise(0.0)
    return df.withColumns(
        {
            "domain_valid": F.when(urls.is_valid_domain("registered"), 1.0).otherwise(0.0),
            "https": F.when(reached, 1.0).otherwise(0.0),
            "status": F.when(reached, status).otherwise(0.0),
            "response_time": F.when(reached, clamp_scale(left, 0, MAX_ELAPSED_S)).otherwise(0.0),
            "domain_age": aged,
            "neutrality": F.when(unread, SHORT_TEXT_VALUE).otherwise(neutral),
            "text_len": F.when(unread, SHORT_TEXT_VALUE).otherwise(length),
            "ugc_score": F.least(known_ugc + page_ugc, F.lit(1.0)),
        }
    )


def reliability_score(exact_trust: bool = False) -> Column:
    """0 to 100 from the feature columns: weighted sum, bonuses, floor, clamp.

    Trusted names match as plain substrings, so ``ft.com`` also hits ``microsoft.com``;
    ``exact_trust`` matches the registered domain instead.
    """
    total = F.lit(0.0)
    for feature, weight in FEATURE_WEIGHTS.items():
        total = total + F.col(feature) * weight
    total = total * 100
    trusted = (
        F.col("registered").isin(TRUSTED_SOURCES)
        if exact_trust
        else urls.contains_any("source_id", TRUSTED_SOURCES)
    )
    institution = urls.ends_with_any("registered", INSTITUTION_ENDINGS)
    total = total + F.when(trusted, TRUST_BONUS).otherwise(0)
    total = total + F.when(institution, INSTITUTION_BONUS).otherwise(0)
    solid = (F.col("domain_age") > FLOOR_MIN_AGE) & (F.col("ugc_score") < FLOOR_MAX_UGC)
    total = F.when(solid, F.greatest(total, F.lit(float(SCORE_FLOOR)))).otherwise(total)
    clamped = F.greatest(F.lit(0.0), F.least(total, F.lit(100.0)))
    return F.when(total.isNull() | F.isnan(total), 0.0).otherwise(F.round(clamped, 2))


def source_scores(features: DataFrame, exact_trust: bool = False) -> DataFrame:
    return features.withColumn("reliability_score", reliability_score(exact_trust))


def rating(score: Column | str) -> Column:
    s = col(score)
    return F.when(s >= RATING_A_FROM, "A").when(s > RATING_B_ABOVE, "B").otherwise("C")


def rate_sources(scores: DataFrame, verified: str | dt.date) -> DataFrame:
    """Mean score per source to two decimals, its rating and the date of verification."""
    mean = F.round(F.avg("reliability_score"), 2)
    return (
        scores.groupBy("source_id")
        .agg(mean.alias("credibility_score"))
        .withColumn("rating", rating("credibility_score"))
        .withColumn("last_verified", dates.date_lit(verified))
    )


def rate_known_and_unprobed(
    sources: DataFrame, probe: DataFrame, as_of: str | dt.date, exact_trust: bool = False
) -> DataFrame:
    """Ratings of the given sources: the mean over their observations, or the score that a
    failed visit gives where there is none.

    In place of a join, every source adds one empty observation, and one aggregation picks
    between the two. It adds up map-side, so a source that holds most of the observations
    is no heavier than the others.
    """
    wanted = sources.select("source_id").distinct()
    return _rate_with_fallback(summarise_probe(probe), wanted, as_of, exact_trust)


def rate_from_first_run(
    articles: DataFrame,
    probe: DataFrame,
    run_col: str = "run_date",
    url: str = "source_url",
    exact_trust: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Ratings of all sources over many runs, each as of the first run that met it.

    This is what an insert-only table holds after rating the sources run by run. Sources
    that ``known`` holds already are left out before anything is rated.
    """
    met = articles.select(urls.source_id(url).alias("source_id"), F.col(run_col).alias("as_of"))
    first = met.where(F.col("source_id").isNotNull()).groupBy("source_id")
    wanted = first.agg(F.min("as_of").alias("as_of"))
    if known is not None:
        wanted = absent(wanted, known, ["source_id"])
    observed = summarise_probe(probe).join(wanted, "source_id")
    return _rate_with_fallback(observed, wanted, F.col("as_of"), exact_trust)


def _rate_with_fallback(
    observed: DataFrame, wanted: DataFrame, as_of: str | dt.date | Column, exact_trust: bool
) -> DataFrame:
    empty = wanted.withColumn("_empty", F.lit(True))
    every = observed.unionByName(empty, allowMissingColumns=True)
    scores = source_scores(source_features(every, as_of), exact_trust)
    score = F.col("reliability_score")
    mean = F.avg(F.when(F.col("_empty").isNull(), score))
    fallback = F.max(F.when(F.col("_empty"), score))
    return (
        scores.groupBy("source_id")
        .agg(
            F.round(F.coalesce(mean, fallback), 2).alias("credibility_score"),
            fallback.alias("_fallback"),
            F.max(dates.date_lit(as_of)).alias("last_verified"),
        )
        .where(F.col("_fallback").isNotNull())
        .select(
            "source_id",
            "credibility_score",
            rating("credibility_score").alias("rating"),
            "last_verified",
        )
    )


def rating_distribution(sources: DataFrame) -> DataFrame:
    return sources.groupBy("rating").agg(F.count(F.lit(1)).alias("n_sources"))


def credibility_stats(sources: DataFrame) -> DataFrame:
    return sources.agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.round(F.avg("credibility_score"), 2).alias("avg_score"),
        F.min("credibility_score").alias("min_score"),
        F.max("credibility_score").alias("max_score"),
    )
