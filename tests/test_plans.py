"""Shapes of the physical plans: what is pushed down, broadcast, limited before a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from checks.views import view
from tapewire.functions import dates
from tapewire.operators import quality
from tapewire.operators.scoring import ModelScorer
from tapewire.plans import ticker_signal
from tests import models


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_core_plans_stay_in_the_jvm_without_cross_joins(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"Python|CartesianProduct|NestedLoop", text)


def test_model_is_the_only_python_step(spark, small):
    scorer = ModelScorer(models.keyword_model)
    raw, prices = view(spark, small, "raw_ticker_news"), view(spark, small, "market_ohlc")
    text = plan(ticker_signal.ticker_signals(raw, prices, scorer))
    assert text.count("ArrowEvalPython") == 1
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize(
    "name",
    ["ticker_clean", "sector_clean", "sector_head_n", "latest_per_day", "top_articles", "upsert_nothing"],
)
def test_groups_are_limited_before_the_shuffle(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert re.search(r"WindowGroupLimit .*Partial", text)
    # Every window reads what a group limit has cut down.
    assert text.count("Window [") <= text.count("Final")


def test_no_article_text_is_shuffled_by_the_signal_plan(spark, small):
    text = plan(QUERIES["ticker_signal"](spark, small))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*)\), ENSURE", text)
    assert len(exchanges) == 3
    assert not any("content" in e or re.search(r"\btext#", e) for e in exchanges)
    below = text.split("Exchange hashpartitioning")[2].splitlines()[1]
    assert "HashAggregate(keys=[ticker" in below and "content" not in below


def test_no_sort_based_aggregate_in_votes_and_ratings(spark, small):
    for name in ["ticker_signal", "vote_counts", "source_rating", "kpi_daily"]:
        assert "SortAggregate" not in plan(QUERIES[name](spark, small))


def test_dimensions_are_broadcast_only_below_the_threshold(spark, small):
    assert plan(QUERIES["ticker_articles_view"](spark, small)).count("BroadcastHashJoin") == 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["ticker_articles_view"](spark, small))
        assert "Broadcast" not in text and text.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans_count_before_a_shuffled_join(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["fk_orphans"](spark, small))
        assert text.index("SortMergeJoin") < text.index("HashAggregate")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_picked_before_dimensions_are_joined(spark, small):
    text = plan(QUERIES["kpi_daily"](spark, small))
    assert text.index("BroadcastHashJoin") < text.index("WindowGroupLimit")


def test_date_slices_and_columns_reach_the_scan(spark, small):
    events = view(spark, small, "signals")
    text = plan(events.where(dates.on_date("created_at", "2024-01-05")).select("ticker_id"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00" in pushed
    assert "LessThan(ts,2024-01-06T00:00" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "value" not in schema and "props" not in schema


def test_recent_signals_take_the_top_without_a_full_sort(spark, small):
    text = plan(QUERIES["ticker_articles_recent"](spark, small))
    assert text.count("TakeOrderedAndProject") == 2 and "rangepartitioning" not in text
    # The first pick lies below the joins.
    assert text.rindex("TakeOrderedAndProject") > text.index("BroadcastHashJoin")


@pytest.mark.parametrize("name", list(QUERIES))
def test_scoring_and_parsing_happen_once_per_row(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert len(re.findall(r"split\(lower", text)) <= 1
    assert len(re.findall(r"from_json", text)) <= 1


def test_ratings_need_no_join(spark, small):
    assert "Join" not in plan(QUERIES["source_rating"](spark, small))


def test_probe_pages_stay_out_of_the_shuffle(spark, small):
    text = plan(QUERIES["source_rating"](spark, small))
    for exchange in text.split("Exchange hashpartitioning")[1:]:
        assert "html" not in exchange.splitlines()[1]


def test_duplicate_report_aggregates_before_the_shuffle(spark, small):
    df = quality.duplicate_keys(view(spark, small, "signals"), ["ticker_id"])
    assert "partial_count" in plan(df)
    assert df.where(F.col("n_rows") < 2).isEmpty()


@pytest.mark.parametrize(
    ("name", "scans"), [("upsert_update", 2), ("upsert_nothing", 2), ("constraint_violations", 4)]
)
def test_each_side_is_read_once(spark, small, name, scans):
    assert len(re.findall(r"\n[ +:*()\d-]*Scan parquet|FileScan parquet", plan(QUERIES[name](spark, small)))) <= scans
