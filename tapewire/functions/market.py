"""Price expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapewire.functions.text import col


def finite(c: Column | str) -> Column:
    """Null for NaN and infinities, which sort above or below every number in Spark and poison
    averages, so that they never get in."""
    return F.when(F.abs(col(c)) < float("inf"), col(c))


def price_change_pct(open_: Column | str, close: Column | str) -> Column:
    """Change from open to close in percent; null where the open is zero or a side is missing."""
    o, c = finite(open_), finite(close)
    return F.when(o != 0, (c - o) / o * 100)


def price_trend(open_: Column | str, close: Column | str) -> Column:
    """``positive`` for a change of at least zero, else ``negative``, missing included.

    A rise from an open of zero has no percentage but is still a rise.
    """
    o, c = finite(open_), finite(close)
    up = (price_change_pct(open_, close) >= 0) | ((o == 0) & (c > 0))
    return F.when(up, "positive").otherwise("negative")
