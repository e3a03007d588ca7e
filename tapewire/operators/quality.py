"""Constraint reports and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts. Null keys never clash."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent, with their row counts.

    The child is counted per value first, so the join sees one row per value however
    many rows share it.
    """
    counted = (
        child.where(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("fk_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(pk).alias("fk_value"))
    return counted.join(known, "fk_value", "left_anti")


def violations(
    tables: dict[str, DataFrame],
    unique_keys: dict[str, list[list[str]]],
    required: dict[str, list[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """Every broken constraint of a set of tables as (check, table_name, columns, n_rows).

    One pass over each table turns a row into a fact for each constraint it matters to: a
    key's value, a null, a child's or a parent's value. Equal facts are added up before
    the shuffle, and one grouping by constraint and value serves all checks.
    """
    facts: dict[str, list[Column]] = {table: [] for table in tables}
    for table in tables:
        for keys in unique_keys.get(table, []):
            facts[table].append(_fact("unique", table, ",".join(keys), _value(keys)))
        for name in required.get(table, []):
            null = F.when(F.col(name).isNull(), F.lit(""))
            facts[table].append(_fact("not_null", table, name, null))
    for child, fk, parent, pk in foreign_keys:
        if child in tables and parent in tables:
            facts[child].append(_fact("foreign_key", child, fk, _value([fk])))
            facts[parent].append(_fact("foreign_key", child, fk, _value([pk]), parent=True))
    found = [
        df.select(F.inline(F.array(*facts[table]))) for table, df in tables.items() if facts[table]
    ]
    if not found:
        raise ValueError("no constraint applies to the given tables")
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    constraint = ["check", "table_name", "columns"]
    per_value = (
        every.where(F.col("value").isNotNull())
        .groupBy(*constraint, "value")
        .agg(F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("parent"))
    )
    broken = (
        F.when(F.col("check") == "unique", F.col("n") > 1)
        .when(F.col("check") == "foreign_key", ~F.col("parent") & (F.col("n") > 0))
        .otherwise(F.lit(True))
    )
    return per_value.where(broken).groupBy(*constraint).agg(F.sum("n").alias("n_rows"))


def _value(names: Sequence[str]) -> Column:
    """Key columns as one text, null if one of them is; lengths keep them apart."""
    parts = [F.col(n).cast("string") for n in names]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def _fact(
    check: str, table: str, columns: str, value: Column, parent: bool = False
) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(columns).alias("columns"),
        value.alias("value"),
        F.lit(parent).alias("parent"),
    )


def article_counters(raw: DataFrame, cleaned: DataFrame, missing: str) -> DataFrame:
    """Rows in, rows out and what was lost on the way, from one pass over each side."""
    complete = (
        F.col("title").isNotNull()
        & F.col("content").isNotNull()
        & F.col("source_url").isNotNull()
    )
    zero = F.lit(0).cast("long")
    before = raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(complete).alias("rows_complete"),
    ).withColumns({"rows_out": zero, "missing_ids": zero})
    after = cleaned.agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col(missing).isNull()).alias("missing_ids"),
    ).withColumns({"rows_in": zero, "rows_complete": zero})
    names = ["rows_in", "rows_complete", "rows_out", "missing_ids"]
    counts = before.unionByName(after).agg(*[F.sum(c).alias(c) for c in names])
    return counts.select(
        "rows_in",
        (F.col("rows_in") - F.col("rows_complete")).alias("rows_dropped"),
        (F.col("rows_complete") - F.col("rows_out")).alias("duplicates_removed"),
        "missing_ids",
        "rows_out",
    )
