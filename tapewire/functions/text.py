"""String expressions over article fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as a regular expression, with (?U) in front.
_SPACE = r"[\s\x1c-\x1f]"
_BLANK = rf"(?U)\A{_SPACE}*\z"
_NO_TEXT = rf"(?iU)\A{_SPACE}*(?:nan|none|null)?{_SPACE}*\z"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without whitespace of any kind at the ends; Spark's plain trim removes spaces only."""
    return F.trim(col(c), F.lit(WHITESPACE))


def normalise_ticker(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def content_or_title(content: Column | str, title: Column | str) -> Column:
    """Null or zero-length content becomes the title; content of spaces stays."""
    body = col(content)
    return F.when(F.length(F.coalesce(body, F.lit(""))) == 0, col(title)).otherwise(body)


def title_and_content(title: Column | str, content: Column | str) -> Column:
    return F.concat(
        F.coalesce(col(title), F.lit("")), F.lit(" "), F.coalesce(col(content), F.lit(""))
    )


def clip(c: Column | str, max_chars: int | None) -> Column:
    """The part of a text that a length-limited model reads; no limit keeps all of it."""
    return col(c) if max_chars is None else F.substring(col(c), 1, max_chars)


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | col(c).rlike(_BLANK)


def has_scorable_text(c: Column | str) -> Column:
    """Neither blank nor a spelled-out missing value. Never null."""
    return F.coalesce(~col(c).rlike(_NO_TEXT), F.lit(False))


def escape_html(c: Column | str) -> Column:
    out = col(c)
    # The ampersand comes first, so that later entities are not escaped again.
    for char, entity in [
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("'", "&#x27;"),
    ]:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def article_link(url: Column | str, title: Column | str, escape: bool = True) -> Column:
    """A link to the article; without ``escape`` the texts go in as they are."""
    address, label = (escape_html(c) if escape else col(c) for c in (url, title))
    return F.concat(
        F.lit("<a href='"),
        F.coalesce(address, F.lit("")),
        F.lit("' target='_blank'>"),
        F.coalesce(label, F.lit("")),
        F.lit("</a>"),
    )
