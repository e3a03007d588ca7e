"""Files to DataFrames, always with an explicit schema and always all files."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapewire.operators.columns import align, lower_columns
from tapewire.session import side_session

# Different headers that the CSV files of one folder may have.
MAX_HEADERS = 100


def read_landing(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    run_dates: Sequence[str | dt.date] | None = None,
    run_col: str = "run_date",
    bad_col: str | None = None,
) -> DataFrame:
    """JSON lines under ``root/date=YYYY-MM-DD/`` with the run date as a column.

    The run date comes from the path rather than from partition discovery, because a
    partition column ``date`` would replace the trade date that price rows carry. Given
    run dates limit the listing to their directories. A line that is no JSON is a row of nulls;
    ``bad_col`` names a column that holds its text, null for all other rows.
    """
    base = root.rstrip("/")
    paths = [base] if run_dates is None else [f"{base}/date={d}" for d in run_dates]
    reader = spark.read.option("recursiveFileLookup", "true")
    if bad_col:
        schema = T.StructType([*schema.fields, T.StructField(bad_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_col)
    files = reader.schema(schema).json(paths)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"date=(\d{4}-\d{2}-\d{2})", 1)
    return files.select("*", run.try_cast("date").alias(run_col))


def bad_lines(landed: DataFrame, bad_col: str) -> int:
    """Lines of a landed feed that were no JSON."""
    # Spark refuses to read the column of bad lines alone.
    count = F.count_if(F.col(bad_col).isNotNull()).alias("n")
    return landed.agg(count, F.count(landed.columns[0])).first()["n"]


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files: str = "*.csv",
    multi_line: bool = True,
    by_name: bool = False,
) -> DataFrame:
    """CSV with a header in any letter case and column order; text that does not fit its
    type becomes null. Nothing is inferred.

    All files of a folder must have the same header; reading one that differs raises an
    error, since Spark matches columns by place. With ``by_name`` each file's columns go by its
    own header instead: in any order, further ones dropped, missing ones null. Quoted fields
    may hold doubled quotes and, with ``multi_line``, line breaks, as article texts do; a file
    is then read by one task.
    """
    reader = spark.read.options(
        header=True, multiLine=multi_line, escape='"', pathGlobFilter=files
    )
    if by_name:
        parts = [
            align(reader.schema(_text_columns(names)).csv(paths), schema)
            for names, paths in csv_headers(spark, path, files)
        ]
        if not parts:
            return spark.createDataFrame([], schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    text = _text_columns(reader.csv(path).columns)
    checked = reader.schema(text).option("enforceSchema", "false").csv(path)
    return align(lower_columns(checked), schema)


def _text_columns(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def csv_headers(
    spark: SparkSession, path: str, files: str = "*.csv"
) -> list[tuple[list[str], list[str]]]:
    """(lowered column names, files that have them) of each header in a folder.

    One pass over the lines, in which only the first line of a file gets through; no more
    than that and the paths reach the driver, as with any listing. A header is one line. Empty
    files have none and are left out. Clashing names, or more than MAX_HEADERS headers, are
    an error.
    """
    # At this cost of opening a file no two share a task, so the first row is the header.
    cost = spark.conf.get("spark.sql.files.maxPartitionBytes")
    alone = side_session(spark, {"spark.sql.files.openCostInBytes": cost})
    lines = alone.read.option("pathGlobFilter", files).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    row = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    first = lines.where((F.col("start") == 0) & (row == 0))
    headers = first.groupBy(F.lower("value").alias("header")).agg(
        F.array_sort(F.collect_list("file")).alias("files")
    )
    found: dict[tuple[str, ...], list[str]] = {}
    for header, paths in headers.orderBy("header").collect():
        names = tuple(n.strip() for n in next(csv.reader([header.removeprefix("\ufeff")])))
        if len(set(names)) < len(names):
            raise ValueError(f"a column occurs twice in the header of {paths[0]}")
        found.setdefault(names, []).extend(_escaped(p) for p in paths)
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}")
    return [(list(names), paths) for names, paths in found.items()]


def _escaped(uri: str) -> str:
    """A file's URI as a path for a reader, which takes some signs for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a directory holds a file with the suffix. Lists names, reads no content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return not files.select("path").isEmpty()


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet or CSV file by its suffix, or a directory of either, Parquet preferred."""
    if path.endswith(".parquet"):
        return read_parquet(spark, path, schema)
    if path.endswith(".csv"):
        return read_csv(spark, path, schema)
    try:
        if has_files(spark, path, ".parquet"):
            return read_parquet(spark, path, schema)
        if has_files(spark, path, ".csv"):
            return read_csv(spark, path, schema)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    raise FileNotFoundError(f"no Parquet or CSV file under {path}")
