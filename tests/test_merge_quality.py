import pytest
from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.functions.ids import stable_id
from tapewire.operators import quality
from tapewire.operators.upsert import new_rows, upsert
from tapewire.sources import dimensions
from tests.conftest import rows

SCHEMA = "k string, v int, kept string"


def table(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k string, v int")


def merge(target, incoming, mode):
    return upsert(target, incoming, ["k"], [F.col("v").desc()], mode)


def test_insert_only(spark):
    target = table(spark, ("a", 1, "x"))
    incoming = batch(spark, (" a ", 9), ("b", 2), ("b", 3), (None, 4))
    got = rows(merge(target, incoming, "nothing").orderBy("k"))
    assert got == [("a", 1, "x"), ("b", 3, None)]


def test_update_keeps_columns_that_the_batch_lacks(spark):
    target = table(spark, ("a", 1, "x"), ("c", 5, "y"))
    incoming = batch(spark, (" a ", 9), ("b", 2), ("b", 3))
    got = rows(merge(target, incoming, "update").orderBy("k"))
    assert got == [("a", 9, "x"), ("b", 3, None), ("c", 5, "y")]


def test_update_writes_nulls(spark):
    target = table(spark, ("a", 1, "x"))
    got = rows(merge(target, batch(spark, ("a", None)), "update"))
    assert got == [("a", None, "x")]


@pytest.mark.parametrize("mode", ["nothing", "update"])
def test_merging_twice_is_merging_once(spark, mode):
    target = table(spark, ("a", 1, "x"), ("z", 2, "y"))
    incoming = batch(spark, ("a", 9), ("b", 2), ("b", 3))
    once = merge(target, incoming, mode)
    twice = merge(once, incoming, mode)
    assert sorted(rows(once)) == sorted(rows(twice))
    assert once.schema.fieldNames() == target.schema.fieldNames()


def test_key_of_two_columns_and_bad_arguments(spark):
    target = spark.createDataFrame([("a", 1, 0)], "k string, day int, v int")
    incoming = spark.createDataFrame([("a ", 1, 7), ("a", 2, 8)], "k string, day int, v int")
    order = [F.col("v").asc()]
    assert rows(new_rows(target, incoming, ["k", "day"], order)) == [("a", 2, 8)]
    with pytest.raises(ValueError, match="extra"):
        upsert(target, incoming.withColumn("extra", F.lit(1)), ["k", "day"], order)
    with pytest.raises(ValueError, match="replace"):
        upsert(target, incoming, ["k", "day"], order, "replace")


def test_dimensions_are_seeded_once_and_looked_up_by_name(spark):
    lists = dimensions.sector_lists(spark)
    none = spark.createDataFrame([], schemas.SECTORS)
    sectors = dimensions.seed_sectors(none, lists)
    assert rows(sectors.orderBy("sector_id"))[0] == (1, "technology")
    assert sectors.count() == 5
    tickers = dimensions.seed_tickers(spark.createDataFrame([], schemas.TICKERS), sectors, lists)
    assert tickers.count() == 25
    assert rows(tickers.where("ticker_id = 'BRK.B'")) == [("BRK.B", 3)]
    # Existing rows keep their ids, and tickers follow the ids that are in the table.
    other = spark.createDataFrame([(70, "health")], schemas.SECTORS)
    seeded = dimensions.seed_sectors(other, lists)
    assert seeded.count() == 5
    own = dimensions.seed_tickers(
        spark.createDataFrame([("LLY", 1)], schemas.TICKERS), seeded, lists
    )
    got = dict(rows(own.where("ticker_id in ('LLY', 'JNJ')")))
    assert got == {"LLY": 1, "JNJ": 70}


def test_constraint_reports(spark):
    sectors = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], schemas.SECTORS)
    tickers = spark.createDataFrame([("X", 1), ("Y", 9), ("Z", 9), ("W", None)], schemas.TICKERS)
    assert rows(quality.duplicate_keys(sectors, ["sector_name"])) == [("a", 2)]
    assert rows(quality.orphans(tickers, "sector_id", sectors, "sector_id")) == [(9, 2)]
    report = quality.violations(
        {"sectors": sectors, "tickers": tickers},
        schemas.UNIQUE_KEYS,
        schemas.REQUIRED_COLUMNS,
        schemas.FOREIGN_KEYS,
    )
    assert sorted(rows(report)) == [
        ("foreign_key", "tickers", "sector_id", 2),
        ("not_null", "sectors", "sector_name", 1),
        ("unique", "sectors", "sector_name", 2),
    ]
    with pytest.raises(ValueError, match="no constraint"):
        quality.violations({}, schemas.UNIQUE_KEYS, {}, [])


def test_clean_tables_have_no_violations(spark):
    sectors = spark.createDataFrame([(1, "a")], schemas.SECTORS)
    report = quality.violations(
        {"sectors": sectors}, schemas.UNIQUE_KEYS, schemas.REQUIRED_COLUMNS, schemas.FOREIGN_KEYS
    )
    assert report.isEmpty()


def test_counters(spark):
    raw = spark.createDataFrame(
        [("t", "c", "u"), ("t", "c", "u"), (None, "c", "u"), ("t", "c", "")],
        "title string, content string, source_url string",
    )
    cleaned = raw.dropna().distinct().withColumn("source_id", F.nullif("source_url", F.lit("")))
    got = quality.article_counters(raw, cleaned, "source_id").first().asDict()
    assert got == {
        "rows_in": 4,
        "rows_dropped": 1,
        "duplicates_removed": 1,
        "missing_ids": 1,
        "rows_out": 2,
    }


def test_stable_ids_do_not_collide_on_concatenation(spark):
    df = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("-", "a"), ("", "a")],
        "x string, y string",
    )
    assert df.select(stable_id("x", "y")).distinct().count() == 6
    assert df.select(stable_id("x", "y")).first() == df.select(stable_id("x", "y")).first()
