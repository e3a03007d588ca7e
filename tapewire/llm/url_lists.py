"""Captures against dated URL lists, as the lists stood when the page was fetched.

Entries say that a domain was put on a list or taken off it on a day. Per list and domain they
become intervals of validity, from a day on until before another. A capture is on a list if
its host, or a domain above it, lies in an interval that holds its fetch day.

Intervals are cut at months, so that the join has an equality to go by beside the range: domain
and month. Captures are reduced to distinct hosts and days before it, so a host that has a
third of all captures costs as many rows as it has days. The join back to the captures goes by host
and day; Spark splits its larger groups, as one side has a row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def host(url: str | Column) -> Column:
    """The lowered host of an http or similar URL, without user, port or last dot; or null."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]+)", 2)
    found = F.regexp_replace(F.lower(found), r"\.$", "")
    return F.when(found != "", found)


def domains(host: str) -> Column:
    """The host and all domains above it, as an array."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, since, until) from entries (list, domain, day, listed).

    Entries that change nothing, repeated ones included, are passed over. Where entries of one
    day disagree, the domain is off the list. ``until`` is null for an open interval, and the
    first day outside of any other. Entries with a null are dropped; domains are lowered.
    """
    day = (
        entries.select("list", F.lower("domain").alias("domain"), "day", "listed")
        .dropna()
        .groupBy("list", "domain", "day")
        .agg(F.min("listed").alias("listed"))
    )
    order = Window.partitionBy("list", "domain").orderBy("day")
    before = F.coalesce(F.lag("listed").over(order), F.lit(False))
    changes = day.withColumn("before", before).where("listed != before")
    until = F.lead("day").over(order)
    return (
        changes.withColumn("until", until)
        .where("listed")
        .select("list", "domain", F.col("day").alias("since"), "until")
    )


def on_lists(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Each capture (page_id, url, fetched) with (host, lists, blocked).

    ``fetched`` is a date. ``lists``: the lists it was on that day, sorted, comma-joined.
    A capture whose URL is null or has no host, or without a date, is on none. Repeated rows
    stay. Other columns are dropped.
    """
    rows = captures.select("page_id", "url", "fetched", host("url").alias("host"))
    month = F.trunc("fetched", "month")
    probes = (
        rows.where("host is not null and fetched is not null")
        .select("host", "fetched")
        .distinct()
    )
    near = probes.select(
        "host", "fetched", month.alias("month"), F.explode(domains("host")).alias("domain")
    )
    # Open intervals reach to the last fetch.
    last = F.lit(probes.agg(F.max("fetched").alias("last")).first()["last"]).cast("date")
    valid = (
        intervals(entries)
        .withColumn("end", F.least(F.coalesce(F.date_sub("until", 1), last), last))
        .where("since <= end")
        .withColumn(
            "month",
            F.explode(
                F.sequence(
                    F.trunc("since", "month"), F.trunc("end", "month"), F.expr("interval 1 month")
                )
            ),
        )
        .select("list", "domain", "month", "since", "until")
    )
    active = near.join(valid, ["domain", "month"]).where(
        "fetched >= since and (until is null or fetched < until)"
    )
    found = active.groupBy("host", "fetched").agg(
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists")
    )
    return rows.join(found, ["host", "fetched"], "left").select(
        "page_id",
        "url",
        "fetched",
        "host",
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("lists").isNotNull().alias("blocked"),
    )
