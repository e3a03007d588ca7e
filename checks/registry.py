"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import view
from tapewire import schemas
from tapewire.constants import IMPACT_MODEL_CHARS, VOTE_MODEL_CHARS
from tapewire.functions import dates, labels, text, urls
from tapewire.functions.ids import stable_id
from tapewire.operators import columns, dedupe, history, news, quality, quotes, reliability
from tapewire.operators import reports, scoring, upsert, votes
from tapewire.plans import daily_report, landing, sector_articles, source_reliability
from tapewire.plans import ticker_signal as plan_signals
from tapewire.sinks import keyed, writers
from tapewire.sources import dimensions, payloads, statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given texts are invented words in four languages, so the word lists are theirs.
SCORER = scoring.LexiconScorer(
    positive=("the", "to", "is", "der", "la"), negative=("and", "of", "in", "die", "de")
)
AS_OF = "2024-02-01"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Ticker news and signals


@query
def ticker_signal(spark, sf):
    raw, prices = view(spark, sf, "raw_ticker_news"), view(spark, sf, "market_ohlc")
    out = plan_signals.ticker_signals(raw, prices, SCORER)
    return rounded(out, 6, "price_change_in_percentage")


@query
def ticker_clean(spark, sf):
    return news.clean_ticker_news(view(spark, sf, "raw_ticker_news"))


def ticker_runs(spark, sf) -> DataFrame:
    """Ticker news as five runs landed it, undated articles included."""
    run = F.date_add(F.lit("2024-01-08").cast("date"), (F.col("doc_id") % 5).cast("int"))
    return view(spark, sf, "raw_ticker_news").withColumn("run_date", run)


@query
def ticker_clean_per_run(spark, sf):
    return news.clean_ticker_news(ticker_runs(spark, sf), "run_date")


@query
def ticker_signal_runs(spark, sf):
    prices = view(spark, sf, "market_ohlc")
    out = plan_signals.ticker_signals(ticker_runs(spark, sf), prices, SCORER, "run_date")
    return rounded(out, 6, "price_change_in_percentage")


@query
def undated_articles(spark, sf):
    return news.undated(news.ticker_rows(view(spark, sf, "raw_ticker_news")))


@query
def quotes_per_run(spark, sf):
    # A weekend's runs land Friday's row again.
    run = F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", 3)))
    landed = view(spark, sf, "market_ohlc").withColumn("run_date", run)
    clean = quotes.clean_quotes(landed, "run_date", per_run=True)
    return quotes.price_changes(clean, ["run_date", "open"]).withColumn(
        "price_change_in_percentage", F.round("price_change_in_percentage", 6)
    )


@query
def article_vote(spark, sf):
    rows = news.ticker_rows(view(spark, sf, "raw_ticker_news"))
    labelled = scoring.text_labels(rows, SCORER, ["ticker"])
    voted = votes.majority_vote(votes.distinct_texts(labelled, ["ticker"]))
    return voted.select("ticker", "sentiment", "n_articles", "n_valid")


@query
def vote_counts(spark, sf):
    rows = news.ticker_rows(view(spark, sf, "raw_ticker_news"))
    return votes.vote_counts(scoring.with_labels(rows, SCORER), ["ticker", "date_published"])


@query
def price_change(spark, sf):
    clean = quotes.clean_quotes(view(spark, sf, "market_ohlc"))
    return rounded(quotes.price_changes(clean), 6, "price_change_in_percentage")


@query
def signal_match(spark, sf):
    raw, prices = view(spark, sf, "raw_ticker_news"), view(spark, sf, "market_ohlc")
    out = plan_signals.matched_votes(raw, prices, SCORER)
    return out.select(
        "ticker", "report_date", "n_articles", "n_valid", "n_positive", "n_negative",
        "sentiment_from_yesterday", "price_trend", "match", "has_price",
    )


@query
def prev_trading_day(spark, sf):
    days = view(spark, sf, "market_ohlc").select("symbol", "date")
    return days.select(
        "symbol",
        "date",
        dates.previous_trading_day("date").alias("trade_date"),
        dates.previous_day("date").alias("day_before"),
    )


@query
def report_dates(spark, sf):
    rows = news.ticker_rows(view(spark, sf, "raw_ticker_news"), ["doc_id"])
    return news.on_report_dates(rows).select("doc_id", "date_published", "report_date")


@query
def model_input(spark, sf):
    raw = view(spark, sf, "raw_ticker_news")
    both = text.title_and_content("title", "content")
    return raw.select(
        "doc_id",
        F.sha2(text.clip(both, IMPACT_MODEL_CHARS), 256).alias("impact_input"),
        F.sha2(text.clip("content", VOTE_MODEL_CHARS), 256).alias("vote_input"),
    )


# Sector news


@query
def sector_clean(spark, sf):
    return news.clean_sector_news(view(spark, sf, "raw_sector_news"))


@query
def sector_clean_per_run(spark, sf):
    clean = news.clean_sector_news(view(spark, sf, "raw_sector_news"), "run_date")
    return clean


@query
def publish_window(spark, sf):
    kept = news.publish_window(view(spark, sf, "raw_sector_news"), "run_date")
    return with_digest(kept).select(
        "feed_id", "sector_id", "date_published", "run_date", "content_sha2"
    )


def with_digest(df: DataFrame) -> DataFrame:
    """A digest of the article text, so that texts are compared without being sent."""
    return df.withColumn("content_sha2", F.sha2("content", 256))


@query
def sector_head_n(spark, sf):
    # A small head, so that the limit cuts at every scale of the given tables.
    return sector_head(spark, sf, 3)


@query
def sector_head_20(spark, sf):
    return sector_head(spark, sf, 20)


def sector_head(spark, sf, n: int) -> DataFrame:
    raw = view(spark, sf, "raw_sector_news")
    head = news.head_per_sector(raw, "run_date", "feed_id", n)
    return with_digest(head).select(
        "feed_id", "sector_id", "run_date", "title", "source_url", "content_sha2"
    )


@query
def impact_score(spark, sf):
    raw = view(spark, sf, "raw_sector_news")
    return sector_articles.score_articles(news.clean_sector_news(raw), SCORER)


@query
def impact_stats(spark, sf):
    raw = news.complete_articles(view(spark, sf, "raw_sector_news"))
    return scoring.impact_stats(scoring.with_impact(raw, SCORER))


@query
def sector_article_table(spark, sf):
    return article_table(spark, sf)


def article_table(spark, sf) -> DataFrame:
    raw = view(spark, sf, "raw_sector_news")
    windowed = news.publish_window(raw, "run_date")
    return sector_articles.sector_articles(windowed, SCORER)


@query
def union_feeds(spark, sf):
    tickers = view(spark, sf, "raw_ticker_news")
    sectors = view(spark, sf, "raw_sector_news").drop("run_date")
    both = news.union_feeds(tickers, sectors)
    return both.select(
        "doc_id", "feed_id", "ticker", "sector_id", "title", "content", "date_published",
        "source_url", "author", "source_name",
    )


# Payloads and columns


def payload_table(spark, sf) -> DataFrame:
    """Responses of at most 20 articles, by page id; some failed and some empty."""
    source = F.struct(F.col("source_id").alias("id"), F.col("source_name").alias("name"))
    article = F.struct(
        "position",
        source.alias("source"),
        "author",
        "title",
        "content",
        "url",
        F.col("published").alias("publishedAt"),
    )
    grouped = (
        view(spark, sf, "payload_articles")
        .groupBy("payload_id")
        .agg(F.array_sort(F.collect_list(article)).alias("articles"))
    )
    status = F.when(F.col("payload_id") % 5 == 4, "error").otherwise("ok").alias("status")
    none = F.slice("articles", 1, 0)
    articles = F.when(F.col("payload_id") % 7 == 3, none).otherwise(F.col("articles"))
    body = F.struct(status, F.lit(None).cast("string").alias("message"), articles.alias("articles"))
    return grouped.select(
        F.concat(F.lit("NATION_"), (F.col("payload_id") % 25).cast("string")).alias("ticker"),
        (F.col("payload_id") % 5 + 1).cast("int").alias("sector_id"),
        "payload_id",
        F.to_json(body).alias("payload"),
    )


@query
def payload_flatten(spark, sf):
    return payloads.flatten_ticker_payloads(
        payload_table(spark, sf), keep=("ticker", "payload_id")
    )


@query
def payload_flatten_sector(spark, sf):
    return payloads.flatten_sector_payloads(
        payload_table(spark, sf), keep=("sector_id", "payload_id")
    )


def payload_runs(spark, sf) -> DataFrame:
    """The responses as those of eight runs."""
    run = F.date_add(F.lit("2024-01-03").cast("date"), (F.col("payload_id") % 8 * 3).cast("int"))
    return payload_table(spark, sf).withColumn("run_date", run)


@query
def landing_sector(spark, sf):
    return landing.sector_feed(payload_runs(spark, sf), 20, order=("payload_id", "position"))


@query
def landing_ticker(spark, sf):
    return landing.ticker_feed(payload_runs(spark, sf))


@query
def landing_market(spark, sf):
    prices = quotes.clean_quotes(view(spark, sf, "market_ohlc"))
    return landing.market_feed(prices, view(spark, sf, "tickers"), payload_runs(spark, sf))


@query
def payload_outcomes(spark, sf):
    return payloads.payload_outcomes(payload_table(spark, sf))


@query
def alias_align(spark, sf):
    names = {"ticker": "TOPIC", "date_published": "Date_Published", "content": "Content"}
    raw = view(spark, sf, "raw_ticker_news").withColumnsRenamed(names)
    df = columns.resolve_alias(columns.lower_columns(raw), "ticker", ["stock_ticker", "topic"])
    return columns.align(df, schemas.TICKER_CLEAN, ["doc_id"])


@query
def lenient_projection(spark, sf):
    names = {"symbol": "Ticker", "close": "Last"}
    raw = view(spark, sf, "market_ohlc").withColumnsRenamed(names)
    kept, _ = columns.project_lenient(raw, ["Ticker", "date", "Last", "volume"])
    return columns.project_strict(kept, ["date", "Ticker", "Last"])


# Prices


@query
def quote_on_date(spark, sf):
    return quotes.quote_on_date(view(spark, sf, "price_ticks"), "2024-01-05")


def daily_quotes(spark, sf) -> DataFrame:
    return quotes.clean_quotes(view(spark, sf, "market_ohlc"))


@query
def latest_quote(spark, sf):
    return quotes.latest_quote(daily_quotes(spark, sf), "2024-01-30", lookback_days=5)


@query
def quotes_for_universe(spark, sf):
    return quotes.for_universe(daily_quotes(spark, sf), view(spark, sf, "tickers"))


# Sources


@query
def hosts(spark, sf):
    pages = view(spark, sf, "page_urls")
    named = pages.withColumns({"host": urls.host("url"), "source_id": urls.source_id("url")})
    return named.drop("url")


@query
def registered_domain(spark, sf):
    probe = view(spark, sf, "source_probe").select("source_id").distinct()
    domain = urls.registered_domain("source_id")
    return probe.select(
        "source_id", domain.alias("registered"), urls.is_valid_domain(domain).alias("valid")
    )


SUFFIX_RULES = ["com.pe", "k12.ca.us", "ca.us", "us", "*.ck", "!www.ck"]


@query
def registered_domain_rules(spark, sf):
    hosts = view(spark, sf, "suffix_hosts")
    domain = urls.registered_domain("host", SUFFIX_RULES)
    valid = urls.is_valid_domain(domain).alias("valid")
    return hosts.select("host", domain.alias("registered"), valid)


@query
def registered_domain_table(spark, sf):
    """The same rules as rows, among ten thousand others that no host meets."""
    none = spark.range(10_000).select(F.concat(F.lit("none"), "id", F.lit(".invalid")).alias("rule"))
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string").union(none)
    found = urls.with_registered_domain(view(spark, sf, "suffix_hosts"), rules)
    return found.withColumn("valid", urls.is_valid_domain("registered"))


@query
def distinct_sources(spark, sf):
    return reliability.distinct_sources(view(spark, sf, "raw_sector_news"))


FEATURES = [
    "domain_valid", "https", "status", "response_time", "domain_age", "neutrality", "text_len",
    "ugc_score",
]


@query
def source_features(spark, sf):
    observed = reliability.summarise_probe(view(spark, sf, "source_probe"))
    features = reliability.source_features(observed, AS_OF)
    keep = ["source_id", "registered", *FEATURES]
    return rounded(features.select(*keep), 6, *FEATURES)


@query
def source_score(spark, sf):
    observed = reliability.summarise_probe(view(spark, sf, "source_probe"))
    scores = reliability.source_scores(reliability.source_features(observed, AS_OF))
    rating = reliability.rating("reliability_score").alias("rating")
    return scores.select("source_id", "reliability_score", rating)


def probe_ratings(spark, sf) -> DataFrame:
    observed = reliability.summarise_probe(view(spark, sf, "source_probe"))
    scores = reliability.source_scores(reliability.source_features(observed, AS_OF))
    return reliability.rate_sources(scores, AS_OF)


@query
def source_rating(spark, sf):
    articles, probe = view(spark, sf, "raw_sector_news"), view(spark, sf, "source_probe")
    return source_reliability.rate_article_sources(articles, probe, AS_OF)


@query
def source_rating_first_run(spark, sf):
    articles, probe = view(spark, sf, "raw_sector_news"), view(spark, sf, "source_probe")
    return reliability.rate_from_first_run(articles, probe)


@query
def rating_distribution(spark, sf):
    return reliability.rating_distribution(probe_ratings(spark, sf))


@query
def credibility_stats(spark, sf):
    return reliability.credibility_stats(probe_ratings(spark, sf))


# Merges, dimensions, constraints


def merge_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Signals per ticker and hour: the first ten days as the table, the last 25 as the batch."""
    rows = view(spark, sf, "signals").select(
        F.concat("ticker_id", F.date_format("created_at", " dd HH")).alias("slot"),
        "ticker_article_id",
        "price_change_in_percentage",
        "match",
        "created_at",
    )
    old = rows.where(F.col("created_at") < F.lit("2024-01-11").cast("timestamp_ntz"))
    target = dedupe.first_n(old, ["slot"], [F.col("ticker_article_id").asc()])
    fresh = rows.where(F.col("created_at") >= F.lit("2024-01-06").cast("timestamp_ntz"))
    batch = fresh.drop("match").withColumn("slot", F.concat(F.lit("  "), "slot", F.lit(" ")))
    return target, batch


def merged(spark, sf, on_conflict: str) -> DataFrame:
    target, batch = merge_sides(spark, sf)
    last_first = [F.col("ticker_article_id").desc()]
    return upsert.upsert(target, batch, ["slot"], last_first, on_conflict)


@query
def upsert_nothing(spark, sf):
    return merged(spark, sf, "nothing")


@query
def upsert_update(spark, sf):
    return merged(spark, sf, "update")


def scratch(spark, name: str) -> str:
    """A new folder that all executors share: in the checkpoint folder, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_sides(spark, sf) -> tuple[keyed.KeyedTable, DataFrame, list]:
    """The same table and batch, the table stored by day and in buckets of its key."""
    target, batch = merge_sides(spark, sf)
    by_day = ("day", F.to_date("created_at"))
    table = keyed.KeyedTable(
        spark, scratch(spark, "merge"), target.schema, ["slot"], buckets=8, partition=by_day
    )
    table.append(target)
    return table, batch, [F.col("ticker_article_id").desc()]


@query
def upsert_stored_nothing(spark, sf):
    table, batch, order = stored_sides(spark, sf)
    table.insert(batch, order)
    return table.read().drop("day")


@query
def upsert_stored_update(spark, sf):
    table, batch, order = stored_sides(spark, sf)
    table.update(batch, order)
    return table.read().drop("day")


@query
def latest_per_day(spark, sf):
    return dedupe.latest_per_day(view(spark, sf, "signals"), id_col="ticker_article_id")


@query
def latest_per_ticker(spark, sf):
    return dedupe.latest_per_key(view(spark, sf, "signals"), id_col="ticker_article_id")


@query
def seed_dims(spark, sf):
    sectors, tickers = view(spark, sf, "sectors"), view(spark, sf, "tickers")
    lists = (
        tickers.join(sectors, "sector_id")
        .groupBy("sector_id", "sector_name")
        .agg(F.array_sort(F.collect_list("ticker_id")).alias("symbols"))
    )
    known = sectors.where(F.col("sector_id") <= 2)
    seeded = dimensions.seed_sectors(known, lists)
    listed = dimensions.seed_tickers(tickers.where(F.col("sector_id") == 1), seeded, lists)
    # Days of prices per seeded ticker, from the whole event table.
    days = view(spark, sf, "market_ohlc").groupBy("symbol").agg(F.count("date").alias("n_days"))
    return (
        listed.join(seeded, "sector_id")
        .join(days.withColumnRenamed("symbol", "ticker_id"), "ticker_id", "left")
        .select("ticker_id", "sector_id", "sector_name", "n_days")
    )


@query
def fk_orphans(spark, sf):
    return quality.orphans(
        view(spark, sf, "signals"), "ticker_id", view(spark, sf, "tickers"), "ticker_id"
    )


@query
def pk_duplicates(spark, sf):
    return quality.duplicate_keys(view(spark, sf, "raw_sector_news"), ["source_url"])


@query
def constraint_violations(spark, sf):
    tables = {
        "sectors": view(spark, sf, "sectors"),
        "tickers": view(spark, sf, "tickers"),
        "sector_article": view(spark, sf, "raw_sector_news").withColumn(
            "sector_article_id", F.col("feed_id") % 900
        ),
        "ticker_article": view(spark, sf, "signals"),
    }
    return quality.violations(
        tables, schemas.UNIQUE_KEYS, schemas.REQUIRED_COLUMNS, schemas.FOREIGN_KEYS
    )


@query
def quality_counters(spark, sf):
    raw = view(spark, sf, "raw_sector_news")
    scored = sector_articles.score_articles(news.clean_sector_news(raw), SCORER)
    return quality.article_counters(raw, scored, "source_id")


@query
def stable_ids(spark, sf):
    rows = view(spark, sf, "signals")
    keyed = stable_id("ticker_id", "sentiment_from_yesterday", "ticker_article_id")
    return rows.select("ticker_article_id", keyed.alias("id"))


# Reports


def signal_report(spark, sf) -> DataFrame:
    return reports.signals_view(
        view(spark, sf, "signals"), view(spark, sf, "tickers"), view(spark, sf, "sectors")
    )


def article_report(spark, sf) -> DataFrame:
    return reports.articles_view(article_table(spark, sf), view(spark, sf, "sectors"))


@query
def ticker_articles_view(spark, sf):
    return signal_report(spark, sf)


@query
def ticker_articles_recent(spark, sf):
    return reports.recent_signals(
        view(spark, sf, "signals"), view(spark, sf, "tickers"), view(spark, sf, "sectors"), n=2000
    )


@query
def ticker_articles_every(spark, sf):
    return reports.recent_signals(
        view(spark, sf, "signals"), view(spark, sf, "tickers"), view(spark, sf, "sectors")
    )


@query
def sector_articles_view(spark, sf):
    return reports.newest_articles(article_report(spark, sf))


def latest_daily(spark, sf) -> DataFrame:
    rows = dedupe.latest_per_day(view(spark, sf, "signals"), id_col="ticker_article_id")
    return reports.signals_view(rows, view(spark, sf, "tickers"), view(spark, sf, "sectors"))


@query
def kpi_daily(spark, sf):
    day = F.to_date("created_at").alias("report_date")
    out = reports.kpis(latest_daily(spark, sf), [day])
    return rounded(out, 6, "avg_sentiment", "avg_price_change")


@query
def ticker_summary(spark, sf):
    day = F.to_date("created_at").alias("report_date")
    out = reports.ticker_summary(latest_daily(spark, sf), ["Positive"], [day, "stock_ticker"])
    return rounded(out, 6, "avg_sentiment", "avg_price_change")


@query
def ticker_detail(spark, sf):
    out = reports.ticker_detail(latest_daily(spark, sf))
    return rounded(out, 6, "price_change").withColumn(
        "direction", labels.sign_bucket("price_change")
    )


@query
def top_articles(spark, sf):
    return reports.top_articles_by_day(article_table(spark, sf), view(spark, sf, "sectors"))


REPORT_DATE = "2024-01-17"


def day_report(spark, sf) -> daily_report.DailyReport:
    return daily_report.daily_report(
        view(spark, sf, "signals"),
        article_table(spark, sf),
        view(spark, sf, "tickers"),
        view(spark, sf, "sectors"),
        REPORT_DATE,
        sector_names=["asia", "europe"],
        sentiments=["Negative"],
        detail_ticker="NATION_12",
    )


@query
def report_kpis(spark, sf):
    return rounded(day_report(spark, sf).kpis, 6, "avg_sentiment", "avg_price_change")


@query
def report_summary(spark, sf):
    return rounded(day_report(spark, sf).summary, 6, "avg_sentiment", "avg_price_change")


@query
def report_detail(spark, sf):
    return rounded(day_report(spark, sf).detail, 6, "price_change")


@query
def report_top_articles(spark, sf):
    return day_report(spark, sf).top_articles


def any_report(spark, sf, **selection) -> daily_report.DailyReport:
    return daily_report.daily_report(
        view(spark, sf, "signals"),
        article_table(spark, sf),
        view(spark, sf, "tickers"),
        view(spark, sf, "sectors"),
        REPORT_DATE,
        **selection,
    )


@query
def report_summary_tickers(spark, sf):
    tickers = ["NATION_1", "NATION_12", "NATION_20", "UNLISTED"]
    summary = any_report(spark, sf, sector_names=[], ticker_ids=tickers, sentiments=[]).summary
    return rounded(summary, 6, "avg_sentiment", "avg_price_change")


@query
def report_summary_all(spark, sf):
    return rounded(any_report(spark, sf).summary, 6, "avg_sentiment", "avg_price_change")


@query
def report_kpis_all(spark, sf):
    return rounded(any_report(spark, sf).kpis, 6, "avg_sentiment", "avg_price_change")


@query
def date_bounds(spark, sf):
    return reports.date_bounds(view(spark, sf, "signals"), article_table(spark, sf))


@query
def date_bounds_stored(spark, sf):
    """The same from the files of tables that are written first."""
    root = scratch(spark, "date-bounds")
    signals = view(spark, sf, "signals").withColumn("run_date", F.to_date("created_at"))
    writers.write_partitioned(signals, f"{root}/signals", "run_date")
    sector_articles.article_table(spark, f"{root}/articles").append(article_table(spark, sf))
    return statistics.stored_date_bounds(spark, f"{root}/signals", f"{root}/articles")


@query
def filter_options(spark, sf):
    return reports.sector_options(signal_report(spark, sf), article_report(spark, sf))


@query
def ticker_options(spark, sf):
    asia = reports.select_in(signal_report(spark, sf), "sector_name", ["asia"])
    return reports.options(asia, "stock_ticker")


# History of signals and prices


def trading_days(prices: DataFrame) -> DataFrame:
    """Prices without those of some holidays."""
    return prices.where(~F.dayofmonth("date").isin(4, 5, 9, 15, 22, 23, 24))


@query
def quotes_as_of(spark, sf):
    prices = trading_days(quotes.clean_quotes(view(spark, sf, "market_ohlc")))
    signals = view(spark, sf, "signals")
    days = signals.select(F.col("ticker_id").alias("symbol"), F.to_date("created_at").alias("day"))
    return quotes.quotes_as_of(days, prices, 3)


@query
def signal_match_holidays(spark, sf):
    raw, prices = view(spark, sf, "raw_ticker_news"), view(spark, sf, "market_ohlc")
    out = plan_signals.matched_votes(raw, trading_days(prices), SCORER, lookback_days=3)
    return out.select(
        "ticker", "report_date", "sentiment_from_yesterday", "price_trend", "match", "has_price"
    )


def scored(spark, sf) -> DataFrame:
    signals = view(spark, sf, "signals").join(
        view(spark, sf, "tickers"), "ticker_id", "left"
    )
    score = F.when(F.col("sentiment_from_yesterday"), 1).when(
        ~F.col("sentiment_from_yesterday"), -1
    )
    return signals.withColumn("score", score)


@query
def sentiment_decayed(spark, sf):
    rows = scored(spark, sf)
    parts = []
    for level, key in (("ticker", "ticker_id"), ("sector", "sector_id")):
        daily = history.daily_scores(rows, [key], "score", "created_at")
        named = history.decayed_series(daily, [key], 7.0).withColumn("level", F.lit(level))
        parts.append(named.withColumn("key", F.col(key).cast("string")).drop(key))
    return rounded(parts[0].unionByName(parts[1]), 6, "weight", "score")


@query
def rolling_hit_rate(spark, sf):
    out = history.rolling_rates(
        view(spark, sf, "signals"), "ticker_id", "created_at", "ticker_article_id", "match",
        frames=(5, 60), block=500,
    )
    out = out.select("ticker_article_id", "ticker_id", "position", "rate_5", "rate_60")
    return rounded(out, 9, "rate_5", "rate_60")


def daily_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Mean sentiment and price change of each ticker and day."""
    daily = history.daily_scores(scored(spark, sf), ["ticker_id"], "score", "created_at")
    mean = daily.select("ticker_id", "day", (F.col("total") / F.col("n")).alias("sentiment"))
    changes = quotes.price_changes(quotes.clean_quotes(view(spark, sf, "market_ohlc")))
    return mean, changes.select(
        F.col("symbol").alias("ticker_id"), F.col("date").alias("day"),
        F.col("price_change_in_percentage").alias("change"),
    )


@query
def lagged_correlation(spark, sf):
    mean, changes = daily_sides(spark, sf)
    out = history.lagged_correlation(
        mean, changes, "ticker_id", "day", "sentiment", "change", range(-5, 6)
    )
    return rounded(out, 6, "r", "t")


@query
def trend_slopes(spark, sf):
    mean, changes = daily_sides(spark, sf)
    both = mean.join(changes, ["ticker_id", "day"], "full")
    out = history.slopes(both, "ticker_id", "day", ["sentiment", "change"], [7, 21])
    return rounded(out, 6, *[c for c in out.columns if c not in ("ticker_id", "day")])


@query
def change_points(spark, sf):
    mean, _ = daily_sides(spark, sf)
    out = history.change_points(mean, "ticker_id", "day", "sentiment", 0.25, 2.0)
    return rounded(out, 6, "sentiment", "rise", "fall")
