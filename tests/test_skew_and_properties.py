"""Hot keys, and properties that hold for any input."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.operators import news, votes
from tapewire.operators.dedupe import first_n
from tapewire.operators.quality import orphans
from tapewire.operators.reliability import rate_known_and_unprobed
from tapewire.operators.scoring import LexiconScorer, with_impact
from tapewire.operators.upsert import upsert
from tapewire.plans import ticker_signal
from tests.conftest import rows

SCORER = LexiconScorer(("good",), ("bad",))
D = dt.date
N = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows are copies of one article of one ticker on one day."""
    is_hot = F.col("id") % 3 == 0
    day = (F.col("id") % 11).cast("int")
    return spark.range(0, N, 1, 8).select(
        F.when(is_hot, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 500)).alias("ticker"),
        F.when(is_hot, "bad news").otherwise(F.concat(F.lit("good "), F.col("id") % 7000)).alias("content"),
        F.lit("t").alias("title"),
        F.when(is_hot, "2024-01-05")
        .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), day).cast("string"))
        .alias("date_published"),
        F.when(is_hot, "https://hot.com/").otherwise(F.concat(F.lit("https://x.com/"), "id")).alias("source_url"),
    )


def test_hot_article_is_one_row_and_one_vote(spark, hot):
    local = [(i % 500, i % 7000) for i in range(N) if i % 3]
    clean = news.clean_ticker_news(hot)
    assert clean.count() == len(set(local)) + 1
    flat = spark.createDataFrame([], "symbol string, date date, open double, close double")
    voted = ticker_signal.ticker_votes(hot, SCORER)
    got = rows(voted.where("ticker = 'HOT'").select("report_date", "n_articles", "sentiment").orderBy("report_date"))
    assert got == [(D(2024, 1, 6), 1, "negative"), (D(2024, 1, 7), 1, "negative")]
    expected = {(i % 500, d, i % 7000) for i in range(N) if i % 3 for d in (i % 11 + 1, i % 11 + 2)}
    assert voted.where("ticker <> 'HOT'").agg(F.sum("n_articles")).first()[0] == len(expected)
    assert ticker_signal.ticker_signals(hot, flat, SCORER).where("match").isEmpty()


def test_few_rows_of_a_hot_key_cross_the_shuffle(spark, hot):
    df = first_n(hot, ["source_url"], [F.col("content").asc()])
    df.collect()
    metrics = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in metrics
    # After the first stage at most one row per map task is left of the hot key.
    hot_rows = hot.where("ticker = 'HOT'").withColumn("part", F.spark_partition_id())
    per_task = first_n(hot_rows, ["source_url", "part"], [F.col("content").asc()]).count()
    assert per_task == 8
    assert df.count() == N - N // 3 + 1


def test_hot_foreign_key_and_hot_source(spark, hot):
    parent = spark.createDataFrame([("T1", 1)], schemas.TICKERS)
    lost = dict(rows(orphans(hot, "ticker", parent, "ticker_id")))
    assert lost["HOT"] == N // 3 and "T1" not in lost
    assert sum(lost.values()) == N - sum(1 for i in range(N) if i % 3 and i % 500 == 1)
    probe = hot.select(
        F.when(F.col("ticker") == "HOT", "hot.com").otherwise("x.com").alias("source_id"),
        F.lit(200).alias("status_code"),
        F.lit(1.0).alias("elapsed_s"),
        F.lit("").alias("html"),
        F.lit("2000-01-01").cast("date").alias("creation_date"),
        F.lit(None).cast("string").alias("article_text"),
        F.lit(None).cast("double").alias("polarity"),
    )
    wanted = spark.createDataFrame([("hot.com",), ("new.xyz",)], "source_id string")
    rated = {r.source_id: r.credibility_score for r in rate_known_and_unprobed(wanted, probe, "2024-02-01").collect()}
    assert set(rated) == {"hot.com", "new.xyz"} and rated["new.xyz"] == 18.0


def test_hot_key_in_a_merge(spark, hot):
    target = hot.select("source_url", F.lit(0).alias("v")).where("source_url = 'https://hot.com/'").limit(1)
    batch = hot.select("source_url", F.lit(1).alias("v"))
    for mode, value in [("nothing", 0), ("update", 1)]:
        merged = upsert(target, batch, ["source_url"], [F.col("v").asc()], mode)
        assert merged.count() == N - N // 3 + 1
        assert rows(merged.where("source_url like '%hot%'").select("v")) == [(value,)]


def shuffled(spark, data, schema, partitions, seed):
    copy = list(data)
    random.Random(seed).shuffle(copy)
    return spark.createDataFrame(copy, schema).repartition(partitions)


articles = st.lists(
    st.tuples(
        st.sampled_from(["A", " a", "B", "", None]),
        st.sampled_from(["good", "bad", "bad good", "", " ", "NaN", None]),
        st.sampled_from(["t", None]),
        st.sampled_from(["2024-01-01", "2024-01-02T00:00:00Z", "x", None]),
        st.sampled_from(["u1", "u2", None]),
    ),
    max_size=25,
)
SCHEMA = "ticker string, content string, title string, date_published string, source_url string"
few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@few
@given(data=articles)
def test_cleaning_twice_is_cleaning_once(spark, data):
    once = news.clean_ticker_news(spark.createDataFrame(data, SCHEMA))
    twice = news.clean_ticker_news(once)
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice)))


@few
@given(data=articles, seed=st.integers(0, 99))
def test_results_do_not_depend_on_row_order_or_partitions(spark, data, seed):
    def run(df):
        clean = news.clean_ticker_news(df)
        voted = votes.majority_vote(
            clean.select("ticker", F.lower("content").alias("label"))
        )
        return sorted(map(str, rows(clean))), sorted(map(str, rows(voted)))

    assert run(spark.createDataFrame(data, SCHEMA)) == run(shuffled(spark, data, SCHEMA, 3, seed))


@few
@given(data=articles)
def test_impact_is_bounded(spark, data):
    scored = with_impact(spark.createDataFrame(data, SCHEMA), SCORER)
    assert scored.where("impact_score is null or abs(impact_score) > 1").isEmpty()


@few
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from(["reuters.com", "a.gov", "reddit.com", "x.xyz", "bad_host", ""]),
            st.sampled_from([None, 200, 404]),
            st.one_of(st.none(), st.floats(0, 60)),
            st.sampled_from([None, "", "Talk: page"]),
            st.sampled_from([None, D(1990, 1, 1), D(2030, 1, 1)]),
            st.sampled_from([None, "short", "x" * 5000]),
            st.one_of(st.none(), st.floats(-1, 1)),
        ),
        min_size=1,
        max_size=10,
    )
)
def test_scores_lie_between_0_and_100(spark, data):
    probe = spark.createDataFrame(data, schemas.SOURCE_PROBE)
    rated = rate_known_and_unprobed(probe.select("source_id"), probe, "2024-02-01")
    assert rated.count() == len({d[0] for d in data})
    assert rated.where("not (credibility_score between 0 and 100)").isEmpty()
