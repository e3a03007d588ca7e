import datetime as dt
import re

from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.operators.columns import align
from tapewire.plans.sector_articles import article_table
from tapewire.sinks import writers
from tapewire.sources.statistics import stored_date_bounds
from tests.conftest import rows

D = dt.date


def store(spark, root, signal_days, article_days):
    signals = spark.createDataFrame([(d,) for d in signal_days], "run_date date")
    table = align(signals.withColumn("created_at", F.col("run_date").cast("timestamp_ntz")),
                  schemas.with_run_date(schemas.TICKER_ARTICLE))
    if not signal_days:
        writers.create_table(spark, f"{root}/signals", schemas.TICKER_ARTICLE, "run_date")
    writers.write_partitioned(table, f"{root}/signals", "run_date")
    articles = spark.createDataFrame(
        [(f"https://a/{i}", d) for i, d in enumerate(article_days)],
        "source_url string, date_published date",
    )
    article_table(spark, f"{root}/articles", 4).append(articles)
    return stored_date_bounds(spark, f"{root}/signals", f"{root}/articles")


def test_bounds_come_from_footers_alone(spark, tmp_path):
    days = [D(2024, 1, 9), D(2024, 1, 7)] * 20
    published = [D(2024, 1, 6), None, D(2023, 12, 30), D(2024, 1, 8)] * 5
    found = store(spark, str(tmp_path), days, published)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedAggregation: \[([^\]]*)\]", plan)
    assert len(pushed) == 2 and "FileScan" not in plan
    assert "COUNT(*)" in pushed[0] and "MIN(date_published)" in pushed[1]
    # One row for each file, however many rows the files hold.
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas_read) == 2 and not any("created_at:" in s for s in schemas_read)
    assert rows(found) == [(D(2023, 12, 30), D(2024, 1, 9))]


def test_bounds_of_undated_and_empty_tables(spark, tmp_path):
    assert rows(store(spark, str(tmp_path / "a"), [D(2024, 1, 9)], [None, None])) == [
        (D(2024, 1, 9), D(2024, 1, 9))
    ]
    assert rows(store(spark, str(tmp_path / "b"), [D(2024, 1, 9)], [])) == [
        (D(2024, 1, 9), D(2024, 1, 9))
    ]
    assert rows(store(spark, str(tmp_path / "c"), [], [D(2024, 2, 1)])) == [
        (D(2024, 2, 1), D(2024, 2, 1))
    ]


def test_the_session_keeps_its_settings(spark, tmp_path):
    names = ["spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"]
    before = [spark.conf.get(n) for n in names]
    store(spark, str(tmp_path), [D(2024, 1, 9)], [D(2024, 1, 9)])
    assert [spark.conf.get(n) for n in names] == before
