"""Column names, types and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def resolve_alias(
    df: DataFrame, target: str, candidates: Sequence[str], on_missing: str = "null"
) -> DataFrame:
    """Rename the first present candidate to ``target``.

    With none present, ``on_missing`` decides: a null string column, or an error.
    """
    if target in df.columns:
        return df
    for name in candidates:
        if name in df.columns:
            return df.withColumnRenamed(name, target)
    if on_missing == "error":
        raise ValueError(f"none of the columns {list(candidates)} is present for {target!r}")
    return df.withColumn(target, F.lit(None).cast("string"))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def align(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The schema's columns in order: missing ones as typed nulls, the rest cast.

    Values that do not fit the type become null instead of failing the job.
    """
    out = [F.col(name) for name in keep]
    for field in schema.fields:
        if field.name not in df.columns:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            value = F.col(field.name)
        else:
            value = F.col(field.name).try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def project_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*columns)


def project_lenient(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that are present, and the names of those that are not."""
    missing = [name for name in columns if name not in df.columns]
    return df.select(*[name for name in columns if name in df.columns]), missing


def require_non_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
