import datetime as dt
import json
import uuid
from types import SimpleNamespace

import pytest

from tapewire import schemas
from tapewire.operators import quality
from tapewire.operators.scoring import LexiconScorer, ModelScorer
from tapewire.plans.daily_run import TABLES, create_warehouse, run_day, run_days
from tapewire.session import checkpoint_root
from tapewire.streaming.ingest import load_new_sector_articles
from tapewire.plans import landing
from tapewire.plans.daily_report import daily_report
from tapewire.sources.readers import read_landing
from tests import models
from tests.conftest import rows

D = dt.date
SCORER = LexiconScorer(("good",), ("bad",))


def land(root, kind, day, *records):
    folder = root / kind / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))


def ticker_item(ticker, content, url):
    return {"ticker": ticker, "content": content, "title": "t", "source_url": url}


def sector_item(sector_id, content, url):
    return {"sector_id": sector_id, "title": "t", "content": content, "source_url": url}


def land_day(root, day, trade_day, close, url):
    land(root, "news/ticker", day, ticker_item("MSFT", "good", url), ticker_item("msft", "good", url))
    land(
        root,
        "news/sector",
        day,
        sector_item(1, f"good {day}", "https://www.reuters.com/shared"),
        sector_item(2, "bad", url),
    )
    quote = {"symbol": "MSFT", "date": trade_day, "open": 1.0, "high": 2.0, "low": 1.0, "close": close}
    land(root, "market", day, quote)


@pytest.fixture
def probe(spark):
    return spark.createDataFrame(
        [("www.reuters.com", 200, 0.5, "", dt.date(2000, 1, 1), "x" * 2500, 0.0)],
        schemas.SOURCE_PROBE,
    )


def test_days_build_up_a_consistent_warehouse(spark, tmp_path, probe):
    landing, curated, warehouse = (str(tmp_path / n) for n in ("landing", "curated", "warehouse"))
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    land_day(tmp_path / "landing", "2024-01-09", "2024-01-08", 0.5, "https://b.com/2")
    create_warehouse(spark, warehouse)
    create_warehouse(spark, warehouse)

    def run(day):
        return run_day(spark, landing, curated, warehouse, probe, day, SCORER, SCORER)

    assert run("2024-01-08") == {
        "ticker_clean": 1,
        "sector_clean": 2,
        "ticker_article": 1,
        "sources": 2,
        "sector_article": 2,
        "articles_of_unknown_sector": 0,
        "signals_of_unknown_ticker": 0,
        "sector_rows_in": 2,
        "sector_rows_dropped": 0,
        "sector_duplicates_removed": 0,
        "bad_lines": 0,
    }
    second = run("2024-01-09")
    assert (second["sources"], second["sector_article"]) == (1, 1)
    again = run("2024-01-09")
    assert (again["ticker_article"], again["sources"], again["sector_article"]) == (1, 0, 0)

    signals = spark.read.parquet(f"{warehouse}/ticker_article").orderBy("created_at")
    assert [(r.price_change_in_percentage, r.match) for r in signals.collect()] == [
        (100.0, True),
        (-50.0, False),
    ]
    # The first run to see an address keeps it.
    shared = spark.read.parquet(f"{warehouse}/sector_article").where("source_url like '%shared'")
    assert [(r.created_at, r.impact_score) for r in shared.collect()] == [
        (dt.datetime(2024, 1, 8), 1.0)
    ]
    tables = {name: spark.read.parquet(f"{warehouse}/{name}") for name in TABLES}
    tables["ticker_article"] = signals
    assert tables["tickers"].count() == 25
    report = quality.violations(
        tables, schemas.UNIQUE_KEYS, schemas.REQUIRED_COLUMNS, schemas.FOREIGN_KEYS
    )
    assert report.isEmpty()


def test_refused_rows_and_bad_lines_are_counted(spark, tmp_path, probe):
    landing, curated, warehouse = (str(tmp_path / n) for n in ("landing", "curated", "warehouse"))
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    ticker, sector = (tmp_path / f"landing/news/{k}/date=2024-01-08" for k in ("ticker", "sector"))
    (ticker / "more.jsonl").write_text(json.dumps(ticker_item("NOPE", "good", "u")) + "\n{broken\n")
    more = [sector_item(77, "good", "https://c.com/3"), {"sector_id": 1}, sector_item(2, "bad", "https://a.com/1")]
    (sector / "more.jsonl").write_text("".join(json.dumps(r) + "\n" for r in more) + "no json\n")
    create_warehouse(spark, warehouse)
    got = run_day(spark, landing, curated, warehouse, probe, "2024-01-08", SCORER, SCORER)
    assert got["bad_lines"] == 2
    assert (got["articles_of_unknown_sector"], got["signals_of_unknown_ticker"]) == (1, 1)
    assert (got["sector_rows_in"], got["sector_rows_dropped"], got["sector_duplicates_removed"]) == (5, 1, 1)
    assert (got["ticker_article"], got["sector_article"]) == (1, 2)


def test_a_second_run_scores_nothing(spark, tmp_path, probe):
    landing, curated, warehouse = (str(tmp_path / n) for n in ("landing", "curated", "warehouse"))
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    create_warehouse(spark, warehouse)
    (tmp_path / "calls").mkdir()
    model = ModelScorer(models.load_counter(str(tmp_path / "calls")))
    calls = []
    for _ in range(2):
        run_day(spark, landing, curated, warehouse, probe, "2024-01-08", SCORER, model)
        calls.append(len(list((tmp_path / "calls").iterdir())))
    assert calls[0] > 0 and calls[1] == calls[0]


def test_stored_signals_are_read_by_partition(spark, tmp_path, probe, capsys):
    landing, curated, warehouse = (str(tmp_path / n) for n in ("landing", "curated", "warehouse"))
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    create_warehouse(spark, warehouse)
    run_day(spark, landing, curated, warehouse, probe, "2024-01-08", SCORER, SCORER)
    tables = {n: spark.read.parquet(f"{warehouse}/{n}") for n in [*TABLES, "ticker_article"]}
    report = daily_report(
        tables["ticker_article"], tables["sector_article"], tables["tickers"], tables["sectors"],
        "2024-01-08",
    )
    report.detail.explain("formatted")
    assert "PartitionFilters: [isnotnull(run_date" in capsys.readouterr().out
    assert report.detail.count() == 1
    report.top_articles.explain("formatted")
    assert "PartitionFilters: [isnotnull(published_month" in capsys.readouterr().out


def test_a_backlog_equals_its_days_in_turn(spark, tmp_path, probe):
    landing = tmp_path / "landing"
    land_day(landing, "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    land_day(landing, "2024-01-09", "2024-01-08", 0.5, "https://b.com/2")
    land_day(landing, "2024-01-10", "2024-01-09", 1.5, "https://www.reuters.com/3")
    # Two runs land Friday's price, the second of them revised.
    land_day(landing, "2024-01-06", "2024-01-05", 0.5, "https://a.com/0")
    days = ["2024-01-06", "2024-01-08", "2024-01-09", "2024-01-10"]
    in_turn, at_once = tmp_path / "in_turn", tmp_path / "at_once"

    def run(root, dates_):
        return run_days(
            spark, str(landing), f"{root}/curated", f"{root}/warehouse", probe, dates_, SCORER, SCORER
        )

    for root in (in_turn, at_once):
        create_warehouse(spark, f"{root}/warehouse")
    counts = [run(in_turn, [day]) for day in days]
    total = run(at_once, days)
    assert total == {k: sum(c[k] for c in counts) for k in total}
    for table in [*TABLES, "ticker_article"]:
        a, b = (spark.read.parquet(f"{root}/warehouse/{table}") for root in (in_turn, at_once))
        assert sorted(map(str, rows(a))) == sorted(map(str, rows(b)))
        assert not a.isEmpty()
    verified = dict(rows(spark.read.parquet(f"{at_once}/warehouse/sources").select("source_id", "last_verified")))
    assert verified["www.reuters.com"] == dt.date(2024, 1, 6)
    assert verified["b.com"] == dt.date(2024, 1, 9)


def test_a_day_without_prices_stops(spark, tmp_path, probe):
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    (tmp_path / "landing/market/date=2024-01-08/part.jsonl").write_text("")
    with pytest.raises(ValueError, match="market landing"):
        run_day(
            spark, str(tmp_path / "landing"), str(tmp_path / "c"), str(tmp_path / "w"), probe,
            "2024-01-08", SCORER, SCORER,
        )


def test_a_day_without_news_writes_empty_tables(spark, tmp_path, probe):
    land_day(tmp_path / "landing", "2024-01-08", "2024-01-05", 2.0, "https://a.com/1")
    for kind in ("ticker", "sector"):
        (tmp_path / f"landing/news/{kind}/date=2024-01-08/part.jsonl").write_text("")
    warehouse = str(tmp_path / "w")
    create_warehouse(spark, warehouse)
    got = run_day(
        spark, str(tmp_path / "landing"), str(tmp_path / "c"), warehouse, probe, "2024-01-08",
        SCORER, SCORER,
    )
    assert set(got.values()) == {0}


def test_incremental_load_skips_what_is_there(spark, tmp_path):
    landing, table = tmp_path / "sector", str(tmp_path / "articles")
    name = f"test_load_{uuid.uuid4().hex}"

    def load():
        query = load_new_sector_articles(
            spark, str(landing), table, SCORER, name
        )
        query.awaitTermination()
        return sorted(rows(spark.read.parquet(table).select("source_url", "impact_score", "created_at")))

    one, two = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 9)
    land(tmp_path, "sector", "2024-01-08", sector_item(1, "good", "https://a.com/1"))
    assert load() == [("https://a.com/1", 1.0, one)]
    land(
        tmp_path,
        "sector",
        "2024-01-09",
        sector_item(1, "bad", " https://a.com/1"),
        sector_item(1, "bad", "https://a.com/2"),
    )
    expected = [("https://a.com/1", 1.0, one), ("https://a.com/2", -1.0, two)]
    assert load() == expected
    assert load() == expected


def test_checkpoint_folder_comes_from_the_session():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: settings.get(k, d)))

    named = session(**{"spark.checkpoint.dir": "/shared/x/"})
    assert checkpoint_root(named) == "/shared/x"
    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_root(session())


def test_feeds_are_landed_and_read_again(spark, tmp_path):
    payload = json.dumps({"status": "ok", "articles": [
        {"title": f"t{i}", "content": "c", "url": f"https://a.com/{i}", "publishedAt": f"2024-01-0{i}T08:00:00Z"}
        for i in range(5, 9)
    ]})
    runs = [(1, "MSFT", D(2024, 1, 8), payload), (1, "MSFT", D(2024, 1, 9), payload), (2, "AAPL", D(2024, 1, 9), "{")]
    payloads = spark.createDataFrame(runs, "sector_id int, ticker string, run_date date, payload string")
    sector, ticker = landing.sector_feed(payloads, 1), landing.ticker_feed(payloads)
    assert sorted(rows(sector.select("run_date", "title"))) == [(D(2024, 1, 8), "t6"), (D(2024, 1, 9), "t7")]
    quotes = spark.createDataFrame(
        [("MSFT", D(2024, 1, 5), 1.0, 1.0, 1.0, 2.0), ("X", D(2024, 1, 5), 1.0, 1.0, 1.0, 2.0),
         ("MSFT", D(2024, 1, 8), 2.0, 2.0, 2.0, 3.0)],
        schemas.MARKET_OHLC,
    )
    tickers = spark.createDataFrame([("MSFT", 1)], schemas.TICKERS)
    market = landing.market_feed(quotes, tickers, payloads)
    for feed, name, schema, n in [
        (sector, "sector", schemas.RAW_SECTOR_NEWS, 2),
        (ticker, "ticker", schemas.RAW_TICKER_NEWS, 4),
        (market, "market", schemas.MARKET_OHLC, 2),
    ]:
        path = str(tmp_path / name)
        assert landing.land(feed, path) == n
        back = read_landing(spark, path, schema, ["2024-01-08", "2024-01-09"])
        assert sorted(map(str, rows(back))) == sorted(map(str, rows(feed.select(back.columns))))


def test_prices_of_many_runs_are_landed_by_one_write(spark, tmp_path):
    days = [D(2024, 1, d) for d in range(8, 13)]
    quotes = [
        (f"S{i}", D(2024, 1, 5), None if i % 3 else 1.5, float("nan"), None, float(i), day)
        for day in days for i in range(20)
    ]
    feed = spark.createDataFrame(quotes, schemas.with_run_date(schemas.MARKET_OHLC))
    path = str(tmp_path / "market")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "prices of many runs")
    try:
        assert landing.land(feed, path) == 100
        jobs = len(tracker.getJobIdsForGroup("landing"))
        spark.sparkContext.setJobGroup("landing-one", "prices of one run")
        assert landing.land(feed.where("run_date = '2024-01-09' and symbol < 'S3'"), path) == 13
        assert len(tracker.getJobIdsForGroup("landing-one")) == jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    back = read_landing(spark, path, schemas.MARKET_OHLC)
    assert back.count() == 93
    kept = feed.where("run_date <> '2024-01-09' or symbol < 'S3'")
    assert sorted(map(str, rows(back))) == sorted(map(str, rows(kept.select(back.columns))))
