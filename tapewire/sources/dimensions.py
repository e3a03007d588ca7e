"""Seeding of the sector and ticker dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.constants import SECTOR_TICKERS
from tapewire.operators.upsert import upsert


def sector_lists(
    spark: SparkSession, mapping: Mapping[str, Sequence[str]] = SECTOR_TICKERS
) -> DataFrame:
    """The seed list as rows (sector_id, sector_name, symbols); ids count from 1."""
    rows = [(i, name, list(symbols)) for i, (name, symbols) in enumerate(mapping.items(), 1)]
    return spark.createDataFrame(
        rows, "sector_id int, sector_name string, symbols array<string>"
    )


def seed_sectors(sectors: DataFrame, lists: DataFrame) -> DataFrame:
    """The sector table with the listed names inserted where they are absent."""
    batch = lists.select("sector_id", "sector_name")
    return upsert(sectors, batch, ["sector_name"], [F.col("sector_id").asc()])


def seed_tickers(tickers: DataFrame, sectors: DataFrame, lists: DataFrame) -> DataFrame:
    """The ticker table with the listed symbols inserted where they are absent.

    Each symbol takes the id that the sector table holds for its sector's name.
    """
    listed = lists.select("sector_name", F.explode("symbols").alias("ticker_id"))
    batch = listed.join(sectors, "sector_name").select("ticker_id", "sector_id")
    return upsert(tickers, batch, ["ticker_id"], [F.col("sector_id").asc()])
