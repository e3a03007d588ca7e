import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.constants import TICKER_ALIASES, VOTE_TICKER_ALIASES
from tapewire.functions import text
from tapewire.operators import columns, dedupe, news
from tests.conftest import rows

D = dt.date


def ticker_news(spark, *values):
    return spark.createDataFrame(
        list(values),
        "ticker string, content string, title string, date_published string, source_url string",
    )


def test_ticker_is_trimmed_and_upper_cased_and_required(spark):
    raw = ticker_news(
        spark,
        (" msft ", "a", "t", None, "u"),
        (None, "b", "t", None, "u"),
        ("", "c", "t", None, "u"),
        ("   ", "d", "t", None, "u"),
    )
    assert rows(news.clean_ticker_news(raw).select("ticker", "content")) == [("MSFT", "a")]


def test_content_falls_back_to_title_only_when_missing_or_empty(spark):
    raw = ticker_news(
        spark,
        ("A", None, "t1", None, "u"),
        ("B", "", "t2", None, "u"),
        ("C", " ", "t3", None, "u"),
        ("D", None, None, None, "u"),
        ("E", "NaN", "t5", None, "u"),
    )
    cleaned = news.clean_ticker_news(raw).orderBy("ticker").select("ticker", "content")
    assert rows(cleaned) == [("A", "t1"), ("B", "t2"), ("C", " "), ("E", "NaN")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Singapore", "America/New_York"])
def test_dates_keep_their_written_day_in_every_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = ticker_news(
            spark,
            ("A", "1", "t", "2025-11-05T23:34:56Z", "u"),
            ("A", "2", "t", "2025-11-05T23:34:56+09:00", "u"),
            ("A", "3", "t", "2025-11-05", "u"),
            ("A", "4", "t", "n/a", "u"),
            ("A", "5", "t", None, "u"),
            ("A", "6", "t", "12:34:56", "u"),
        )
        got = rows(news.clean_ticker_news(raw).orderBy("content").select("date_published"))
        assert got == [(D(2025, 11, 5),)] * 3 + [(None,)] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ticker_duplicates_keep_the_latest_then_first_address(spark):
    raw = ticker_news(
        spark,
        ("A", "same", "t", "2024-01-01", "b"),
        ("A", "same", "t", "2024-01-02", "z"),
        ("a ", "same", "t", "2024-01-02", "c"),
        ("B", "same", "t", None, "c"),
    )
    got = rows(news.clean_ticker_news(raw).orderBy("ticker").select("ticker", "source_url"))
    assert got == [("A", "c"), ("B", "c")]


def test_runs_are_cleaned_apart(spark):
    raw = ticker_news(spark, ("A", "same", "t", None, "u")).withColumn(
        "run_date", F.explode(F.array(F.lit("2024-01-01"), F.lit("2024-01-02")))
    )
    assert news.clean_ticker_news(raw, "run_date").count() == 2
    assert news.clean_ticker_news(raw).count() == 1


@pytest.mark.parametrize("alias", TICKER_ALIASES)
def test_ticker_aliases(spark, alias):
    raw = spark.createDataFrame([("x", "text")], f"{alias} string, content string")
    cleaned = news.clean_ticker_news(raw)
    assert rows(cleaned) == [("X", "text", None, None, None)]
    assert cleaned.schema == schemas.TICKER_CLEAN


def test_first_alias_wins_and_none_gives_nulls_or_an_error(spark):
    raw = spark.createDataFrame([("t", "s")], "topic string, symbol string")
    assert rows(columns.resolve_alias(raw, "ticker", TICKER_ALIASES).select("ticker")) == [("s",)]
    bare = spark.createDataFrame([("x",)], "content string")
    assert news.clean_ticker_news(bare).count() == 0
    with pytest.raises(ValueError, match="ticker"):
        columns.resolve_alias(bare, "ticker", VOTE_TICKER_ALIASES, on_missing="error")


def sector_news(spark, *values):
    return spark.createDataFrame(
        list(values),
        "sector_id int, title string, content string, date_published string, "
        "source_url string, author string, source_name string",
    )


def test_sector_rows_need_title_content_and_address(spark):
    raw = sector_news(
        spark,
        (1, None, "c", None, "u1", "a", "n"),
        (1, "t", None, None, "u2", "a", "n"),
        (1, "t", "c", None, None, "a", "n"),
        (1, "", "", None, "u4", "a", "n"),
    )
    cleaned = news.clean_sector_news(raw)
    assert cleaned.schema == schemas.SECTOR_CLEAN
    assert rows(cleaned) == [(1, "", "", None, "u4", "a", None)]


def test_sector_addresses_merge_after_trimming(spark):
    raw = sector_news(
        spark,
        (1, "old", "c", "2024-01-01T10:00:00Z", " u ", "a", "n"),
        (1, "new", "c", "2024-01-02T10:00:00Z", "u", "a", "n"),
    )
    got = rows(news.clean_sector_news(raw).select("title", "source_url"))
    assert got == [("new", "u")]


def test_first_run_keeps_an_address(spark):
    raw = sector_news(
        spark,
        (1, "second run", "c", "2024-01-05", "u", "a", "n"),
        (1, "first run", "c", "2024-01-01", "u", "a", "n"),
    ).withColumn("run_date", F.when(F.col("title") == "first run", "2024-01-02").otherwise("2024-01-06"))
    got = news.clean_sector_news(raw, "run_date", first_run_wins=True)
    assert rows(got.select("run_date", "title")) == [("2024-01-02", "first run")]


def test_align_backfills_casts_and_never_fails(spark):
    df = spark.createDataFrame([("7", "x"), ("seven", "y")], "sector_id string, sector_name string")
    aligned = columns.align(df.drop("sector_name"), schemas.SECTORS)
    assert aligned.schema == schemas.SECTORS
    assert rows(aligned) == [(7, None), (None, None)]


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.project_strict(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="x"):
        columns.project_strict(df, ["a", "x"])
    kept, missing = columns.project_lenient(df, ["c", "x", "a"])
    assert (kept.columns, missing) == (["c", "a"], ["x"])
    assert columns.lower_columns(df.toDF("A", "Bb", "cC")).columns == ["a", "bb", "cc"]


def test_require_non_empty(spark):
    df = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError, match="prices is empty"):
        columns.require_non_empty(df, "prices")
    assert columns.require_non_empty(spark.range(1), "x").count() == 1


def test_window_keeps_what_names_no_instant(spark):
    cases = [
        (None, True),
        ("", True),
        ("garbage", True),
        ("2020-01-01", True),
        ("2020-01-01T10:00:00", True),
        ("2024-01-07T23:59:59Z", False),
        ("2024-01-08T00:00:00Z", True),
        ("2024-01-09T23:59:59Z", True),
        ("2024-01-09T23:59:59.001Z", False),
        ("2024-01-10T00:00:00Z", False),
        ("2024-01-08T08:00:00+09:00", False),
        ("2024-01-10T08:59:59+09:00", True),
        ("2024-01-10T08:59:59+0900", True),
    ]
    df = spark.createDataFrame([(c[0], i) for i, c in enumerate(cases)], "published string, i int")
    kept = {r.i for r in news.publish_window(df, D(2024, 1, 10), "published").collect()}
    assert kept == {i for i, c in enumerate(cases) if c[1]}
    by_column = df.withColumn("run", F.lit("2024-01-10").cast("date"))
    assert {r.i for r in news.publish_window(by_column, "run", "published").collect()} == kept


def test_head_per_sector_is_positional_after_the_window(spark):
    df = spark.createDataFrame(
        [
            (1, 0, "2024-01-01T00:00:00Z"),
            (1, 1, "2024-01-08T00:00:00Z"),
            (1, 2, None),
            (1, 3, "2024-01-09T00:00:00Z"),
            (2, 0, "2024-01-09T00:00:00Z"),
        ],
        "sector_id int, position int, date_published string",
    )
    head = news.head_per_sector(df, D(2024, 1, 10), "position", n=2)
    got = rows(head.orderBy("sector_id", "position").select("sector_id", "position"))
    assert got == [(1, 1), (1, 2), (2, 0)]


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    got = rows(news.union_feeds(a, b).orderBy("id"))
    assert got == [(1, "x", None), (2, None, "y")]


def test_latest_rows_break_ties_by_id(spark):
    at = dt.datetime(2024, 1, 1, 9)
    df = spark.createDataFrame(
        [(1, "A", at), (2, "A", at), (3, "A", at - dt.timedelta(days=1)), (4, "B", at)],
        "id int, ticker_id string, created_at timestamp_ntz",
    )
    assert {r.id for r in dedupe.latest_per_day(df).collect()} == {2, 3, 4}
    assert {r.id for r in dedupe.latest_per_key(df).collect()} == {2, 4}


def test_whitespace_is_what_python_strips(spark):
    every = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
    assert sorted(text.WHITESPACE) == sorted(every)
    df = spark.createDataFrame([(f"{every}a b{every}",), (every,), (None,)], "c string")
    got = rows(df.select(text.strip("c"), text.is_blank("c"), text.has_scorable_text("c")))
    assert got == [("a b", False, True), ("", True, False), (None, True, False)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("a & b", "https://x.y/?a='1'"), (None, None)], "t string, u string")
    links = [r[0] for r in df.select(text.article_link("u", "t")).collect()]
    assert links[0] == "<a href='https://x.y/?a=&#x27;1&#x27;' target='_blank'>a &amp; b</a>"
    assert links[1] == "<a href='' target='_blank'></a>"
    plain = df.select(text.article_link("u", "t", escape=False)).first()[0]
    assert plain == "<a href='https://x.y/?a='1'' target='_blank'>a & b</a>"
    both = df.select(text.title_and_content("t", F.lit(None).cast("string")))
    assert rows(both) == [("a & b ",), (" ",)]
