"""Sentiment labels, flags and scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapewire.functions.market import finite
from tapewire.functions.text import col


def label_to_flag(label: Column | str) -> Column:
    """positive/negative in any letter case to a boolean; anything else counts as true."""
    low = F.lower(col(label))
    return F.coalesce(
        F.when(low == "positive", True).when(low == "negative", False), F.lit(True)
    )


def flag_to_label(flag: Column | str) -> Column:
    return F.when(col(flag), "Positive").when(~col(flag), "Negative")


def label_to_score(label: Column | str) -> Column:
    """Labels that begin with ``pos`` or ``neg``, in any letter case, to +1 and -1; else 0."""
    low = F.lower(col(label))
    return F.when(low.startswith("pos"), 1).when(low.startswith("neg"), -1).otherwise(0)


def sign_bucket(number: Column | str) -> Column:
    n = col(number)
    return (
        F.when(n.isNull() | F.isnan(n.cast("double")), "unknown")
        .when(n > 0, "up")
        .when(n < 0, "down")
        .otherwise("flat")
    )


def trend_matches(flag: Column | str, trend: Column | str) -> Column:
    """Sentiment agrees with the price trend; without a price row it does not."""
    return F.coalesce(col(flag) == (col(trend) == "positive"), F.lit(False))


def impact(label: Column | str, confidence: Column | str) -> Column:
    """Signed confidence to four decimals, zero for neutral or unscored text. Never null."""
    signed = F.when(col(label) == "positive", col(confidence)).when(
        col(label) == "negative", -col(confidence)
    )
    return F.coalesce(F.round(finite(signed), 4), F.lit(0.0))
