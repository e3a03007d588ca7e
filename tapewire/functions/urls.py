"""Hosts and registered domains of article addresses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapewire.constants import COMPOUND_SUFFIXES
from tapewire.functions.text import col, strip

_AUTHORITY = r"^https?://(?:[^/?#]*@)?(\[[^\]]*\]|[^/:?#]+)"
_IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
# Letters and digits of any script, as an internationalised name has before its conversion.
_DOMAIN = (
    r"^([\p{L}\p{N}]([\p{L}\p{M}\p{N}-]{0,61}[\p{L}\p{M}\p{N}])?\.)+"
    r"([\p{L}\p{M}]{2,63}|xn--[a-z0-9-]{1,59})$"
)


def host(url: Column | str) -> Column:
    """Lower-case host with subdomains, without port or user info; ``''`` where there is none.

    A regular expression rather than ``try_parse_url``, which gives up on hosts with
    underscores or spaces.
    """
    address = strip(url)
    full = F.when(address.rlike("^https?://"), address).otherwise(
        F.concat(F.lit("https://"), address)
    )
    return F.coalesce(F.lower(F.regexp_extract(full, _AUTHORITY, 1)), F.lit(""))


def source_id(url: Column | str) -> Column:
    """The host as a source key; null where the address has none."""
    return F.nullif(host(url), F.lit(""))


def registered_domain(
    host_: Column | str, suffixes: Iterable[str] = COMPOUND_SUFFIXES
) -> Column:
    """Public suffix plus one label, decided row by row without a join.

    ``suffixes`` are rules of the public suffix list: a suffix, ``*.`` and a suffix for any
    label before it, or ``!`` and a host that such a rule does not cover. The longest rule that
    fits wins, an exception before all others; a host that no rule fits has its last label as
    the suffix. The built-in rules are the common ones only: pass ``read_suffixes`` of the full
    list wherever other suffixes occur. A host that is itself a suffix, or an IPv4 address,
    stays as it is.
    """
    h = F.rtrim(F.lower(col(host_)), F.lit("."))
    labels = F.split(h, r"\.")
    n = F.size(labels)
    rules = [r.strip().lower() for r in suffixes]
    depth = lambda rule: rule.count(".") + 1
    keep, exact = F.lit(2), F.lit(None).cast("int")
    for k in range(2, max((depth(r) for r in rules), default=1) + 1):
        of_depth = [r for r in rules if depth(r) == k]
        plain = [r for r in of_depth if r[0] not in "*!"]
        wild = [r[2:] for r in of_depth if r.startswith("*.")]
        excepted = [r[1:] for r in of_depth if r.startswith("!")]
        tail = F.substring_index(h, ".", -k)
        if plain:
            keep = F.when(tail.isin(plain), k + 1).otherwise(keep)
        if wild:
            below = F.substring_index(h, ".", -(k - 1)).isin(wild) & (n >= k)
            keep = F.when(below, k + 1).otherwise(keep)
        if excepted:
            exact = F.when(tail.isin(excepted), k).otherwise(exact)
    keep = F.coalesce(exact, keep)
    domain = F.array_join(F.slice(labels, F.greatest(n - keep + 1, F.lit(1)), keep), ".")
    return F.when(h.rlike(_IPV4), h).otherwise(domain)


def read_suffixes(spark: SparkSession, path: str, most: int = 100_000) -> list[str]:
    """The rules of a file in the public suffix list's format, at most ``most`` of them."""
    line = F.regexp_extract("value", r"^\s*(\S+)", 1)
    rules = spark.read.text(path).select(line.alias("rule"))
    rows = rules.where((F.col("rule") != "") & ~F.col("rule").startswith("//")).limit(most + 1)
    found = sorted({r["rule"] for r in rows.collect()})
    if len(found) > most:
        raise ValueError(f"more than {most} suffix rules")
    return found


def suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule) of each line of a file in the public suffix list's format, of any length."""
    line = F.regexp_extract("value", r"^\s*(\S+)", 1)
    rules = spark.read.text(path).select(F.lower(line).alias("rule")).distinct()
    return rules.where((F.col("rule") != "") & ~F.col("rule").startswith("//"))


def with_registered_domain(
    rows: DataFrame, rules: DataFrame, host_: str = "host", name: str = "registered"
) -> DataFrame:
    """``rows`` with the registered domain of their host by a table of rules (rule).

    As ``registered_domain``, but the rules are data: the plan stays the same for any number.
    Each distinct host asks once for all of its suffixes, the longest match comes from one
    aggregation, and the answers are joined back. A null host has none.
    """
    rule = F.trim(F.lower("rule"))
    keyed = rules.where("trim(rule) <> ''").select(
        F.regexp_replace(rule, r"^(\*\.|!)", "").alias("_suffix"),
        F.when(rule.startswith("!"), "exception").when(rule.startswith("*."), "wild").otherwise(
            "plain").alias("_kind"),
    ).distinct()
    hosts = rows.where(F.col(host_).isNotNull()).select(F.col(host_).alias("_host")).distinct()
    hosts = hosts.withColumn("_plain", F.rtrim(F.lower("_host"), F.lit(".")))
    hosts = hosts.withColumn("_labels", F.split("_plain", r"\."))
    n = F.size("_labels")
    # Of a label more than the longest suffix, no host needs more.
    depth = F.explode(F.sequence(F.lit(1), n)).alias("_depth")
    asked = hosts.select("*", depth)
    suffix = F.array_join(F.slice("_labels", n - F.col("_depth") + 1, F.col("_depth")), ".")
    met = asked.withColumn("_suffix", suffix).join(keyed, "_suffix", "left")
    is_kind = lambda kind: F.col("_kind") == kind
    found = met.groupBy("_host", "_plain", "_labels").agg(
        F.max(F.when(is_kind("exception"), F.col("_depth"))).alias("_exact"),
        F.max(F.when(is_kind("plain") & (F.col("_depth") > 1), F.col("_depth") + 1).when(
            is_kind("wild") & (F.col("_depth") < n), F.col("_depth") + 2)).alias("_keep"),
    )
    keep = F.coalesce("_exact", "_keep", F.lit(2))
    domain = F.array_join(F.slice("_labels", F.greatest(n - keep + 1, F.lit(1)), keep), ".")
    domain = F.when(F.col("_plain").rlike(_IPV4), F.col("_plain")).otherwise(domain)
    answers = found.select(F.col("_host").alias(host_), domain.alias(name))
    return rows.join(answers, host_, "left")


def is_valid_domain(domain: Column | str) -> Column:
    return F.coalesce(
        col(domain).rlike(_DOMAIN) & (F.length(col(domain)) <= 253), F.lit(False)
    )


def ends_with_any(c: Column | str, endings: list[str]) -> Column:
    return any_of(col(c).endswith(e) for e in endings)


def contains_any(c: Column | str, needles: list[str]) -> Column:
    return any_of(col(c).contains(n) for n in needles)


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return F.coalesce(out, F.lit(False))
