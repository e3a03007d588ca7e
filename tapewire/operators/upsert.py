"""Keyed merges of a batch into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tapewire.functions import text
from tapewire.operators.dedupe import first_n


def prepare_batch(
    batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """String keys trimmed, rows with a null key rejected, the first row per key kept."""
    trimmed = {
        k: text.strip(k) for k in keys if isinstance(batch.schema[k].dataType, T.StringType)
    }
    df = batch.withColumns(trimmed) if trimmed else batch
    return first_n(df.dropna(subset=list(keys)), keys, order)


def absent(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys ``stored`` lacks, for rows that are few beside it.

    An anti join can only broadcast its right side, which would be the stored table. So the
    rows' keys go to the table first, by a semi join that can broadcast them, and the rows are
    then held against the keys found. The rows are read twice, the table's keys once.
    """
    names = list(keys)
    held = stored.select(*names).join(rows.select(*names), names, "left_semi")
    return rows.join(held, names, "left_anti")


def new_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The rows that an insert-only merge adds. Reads only the key columns of the target."""
    names = list(keys)
    return absent(prepare_batch(batch, names, order), target, names)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    on_conflict: str = "nothing",
) -> DataFrame:
    """The table after the merge.

    ``nothing`` keeps existing rows as they are. ``update`` overwrites their other columns
    with the batch's values, nulls included; columns that the batch lacks stay. ``order``
    says which of several batch rows with one key comes first. One full outer join on the keys
    brings both sides together; each is read once.
    """
    names = list(keys)
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    if on_conflict not in ("nothing", "update"):
        raise ValueError(f"unknown conflict rule {on_conflict!r}")
    ready = prepare_batch(batch, names, order)
    theirs = [c for c in batch.columns if c not in names]
    new = ready.select(*names, F.struct(F.lit(True).alias("hit"), *theirs).alias("_new"))
    old = target.withColumn("_old", F.lit(True))
    joined = old.join(new, names, "full")
    taken = F.col("_new.hit") if on_conflict == "update" else F.col("_old").isNull()
    out = [
        F.when(taken, F.col(f"_new.{f.name}").cast(f.dataType)).otherwise(F.col(f.name))
        if f.name in theirs
        else F.col(f.name).cast(f.dataType)
        for f in target.schema.fields
    ]
    return joined.select(*[c.alias(f.name) for c, f in zip(out, target.schema.fields, strict=True)])
