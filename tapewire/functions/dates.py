"""Calendar expressions: publish dates, report dates, trading days, windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tapewire.functions.text import col

_MICROS_PER_DAY = 86_400_000_000
# A clock time that ends in a UTC offset. Without one, an instant is not defined.
_HAS_OFFSET = r"[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"


def date_lit(d: dt.date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def calendar_date(c: Column | str) -> Column:
    """The date as written in ``YYYY-MM-DD`` or an ISO timestamp; bad text is null.

    A direct ``try_cast`` keeps the written calendar day in every session time zone.
    """
    return col(c).try_cast("date")


def report_dates(published: Column | str) -> Column:
    """The two report dates D whose news window [D-2, D-1] holds this publish date."""
    d = col(published)
    return F.array(F.date_add(d, 1), F.date_add(d, 2))


def previous_trading_day(report_date: Column | str) -> Column:
    """The last weekday before the report date. Holidays simply have no price row."""
    d = col(report_date)
    back = F.when(F.weekday(d) == 0, 3).when(F.weekday(d) == 6, 2).otherwise(1)
    return F.date_sub(d, back)


def previous_day(report_date: Column | str) -> Column:
    return F.date_sub(col(report_date), 1)


def in_publish_window(published: Column | str, run_date: Column | str | dt.date) -> Column:
    """Keep what was published in [D-2 00:00:00, D-1 23:59:59] UTC, both ends included.

    Text that names no instant (missing, unreadable, or without an offset) is kept.
    Instants are compared as microseconds, so the session time zone plays no part.
    """
    text = col(published)
    day = F.unix_date(date_lit(run_date) if not isinstance(run_date, str) else F.col(run_date))
    micros = F.unix_micros(text.try_cast("timestamp"))
    low = (day - 2).cast("long") * _MICROS_PER_DAY
    high = day.cast("long") * _MICROS_PER_DAY - 1_000_000
    has_instant = F.coalesce(text.rlike(_HAS_OFFSET), F.lit(False)) & micros.isNotNull()
    return ~has_instant | micros.between(low, high)


def publish_instant(published: Column | str, run_date: Column | str) -> Column:
    """The instant that a text names; the start of the run date (UTC) where it names none."""
    text = col(published)
    has_instant = F.coalesce(text.rlike(_HAS_OFFSET), F.lit(False))
    start = F.timestamp_micros(F.unix_date(col(run_date)).cast("long") * _MICROS_PER_DAY)
    return F.coalesce(F.when(has_instant, text.try_cast("timestamp")), start)


def on_date(ts: Column | str, day: dt.date | str | Column) -> Column:
    """One calendar day as a half-open range, which a Parquet scan can push down."""
    d = date_lit(day)
    return (col(ts) >= d.cast("timestamp_ntz")) & (
        col(ts) < F.date_add(d, 1).cast("timestamp_ntz")
    )


def format_day(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def format_minute(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm")


def run_timestamp(run_date: Column | str) -> Column:
    """Logical run date as a timestamp without time zone."""
    return col(run_date).cast("date").cast("timestamp_ntz")


def now_in(zone: str = "Asia/Singapore") -> Column:
    """Wall clock in a zone. Not deterministic; stored rows carry the run date instead."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), F.current_timestamp().cast("timestamp_ntz")
    )
