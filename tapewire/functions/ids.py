"""Row ids that depend on the row's key alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapewire.functions.text import col


def stable_id(*keys: Column | str) -> Column:
    """SHA-256 over length-prefixed key values, so no two keys can read the same."""
    parts = []
    for key in keys:
        text = col(key).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.sha2(F.concat_ws("|", *parts), 256)


def text_key(text: Column | str) -> Column:
    """32 bytes that stand for a text in shuffles."""
    return F.unhex(F.sha2(col(text), 256))
