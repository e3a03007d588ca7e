"""The registered queries in SQL for DuckDB, written from the rules and not from the code."""

from __future__ import annotations

from checks.views import cte
from tapewire.constants import TRUSTED_SOURCES, UGC_PHRASES, UGC_SITES

ORACLE: dict[str, str] = {}

POSITIVE = "'the','to','is','der','la'"
NEGATIVE = "'and','of','in','die','de'"


def words(text: str, listed: str) -> str:
    return (
        f"len(list_filter(string_split_regex(lower({text}), '[^a-z]+'), "
        f"lambda w: w in ({listed})))"
    )


def label(p: str = "p", n: str = "n") -> str:
    return f"case when {p} > {n} then 'positive' when {p} < {n} then 'negative' else 'neutral' end"


def stable_id(*keys: str) -> str:
    parts = [
        f"coalesce(length(cast({k} as varchar)) || ':' || cast({k} as varchar), '-')" for k in keys
    ]
    return "sha256(" + " || '|' || ".join(parts) + ")"


def add(name: str, views: list[str], steps: list[tuple[str, str]], select: str) -> None:
    with_clause = cte(*views)
    for step, sql in steps:
        with_clause += f",\n{step} as ({sql})"
    ORACLE[name] = f"{with_clause}\n{select}"


# Shared steps, each (name, select).

TICKER_ROWS = (
    "ticker_rows",
    """
select * from (
  select doc_id, upper(trim(ticker, ' ')) ticker,
    case when content is null or content = '' then title else content end as content,
    title, try_cast(substr(date_published, 1, 10) as date) date_published, source_url
  from raw_ticker_news) r
where ticker <> '' and content <> ''""",
)
TICKER_LABELS = (
    "ticker_labels",
    f"""
select *, case when regexp_matches(lower(content), '^\\s*(nan|none|null)?\\s*$') then null
  else {label()} end as label
from (select *, {words('content', POSITIVE)} p, {words('content', NEGATIVE)} n
  from ticker_rows) s""",
)
REPORT_ROWS = (
    "report_rows",
    """
select distinct ticker, date_published + k.off report_date, content, label
from ticker_labels, (values (1), (2)) k(off)
where date_published is not null""",
)
VOTES = (
    "report_votes",
    """
select ticker, report_date, count(*) n_articles,
  count(*) filter (label in ('positive', 'negative')) n_valid,
  count(*) filter (label = 'positive') n_positive,
  count(*) filter (label = 'negative') n_negative
from report_rows group by all""",
)
CHANGES = (
    "changes",
    """
select symbol, date, case when open <> 0 then (close - open) / open * 100 end pct,
  case when (open <> 0 and (close - open) / open * 100 >= 0) or (open = 0 and close > 0)
    then 'positive' else 'negative' end trend
from (select symbol, date, case when isfinite(open) then open end open,
  case when isfinite(close) then close end as close from market_ohlc) m""",
)
MATCHED = (
    "matched",
    """
select v.*, n_positive >= n_negative sent, c.pct, c.trend,
  coalesce((n_positive >= n_negative) = (c.trend = 'positive'), false) hit
from report_votes v left join changes c on c.symbol = v.ticker and c.date =
  v.report_date - case isodow(v.report_date) when 1 then 3 when 7 then 2 else 1 end""",
)
SIGNAL_STEPS = [TICKER_ROWS, TICKER_LABELS, REPORT_ROWS, VOTES, CHANGES, MATCHED]
SIGNAL_VIEWS = ["raw_ticker_news", "market_ohlc"]

add(
    "ticker_signal",
    SIGNAL_VIEWS,
    SIGNAL_STEPS,
    f"""
select {stable_id('ticker', 'report_date')} id, ticker ticker_id, sent sentiment_from_yesterday,
  round(pct, 6) price_change_in_percentage, hit as match, cast(report_date as timestamp) created_at
from matched""",
)
add(
    "signal_match",
    SIGNAL_VIEWS,
    SIGNAL_STEPS,
    """
select ticker, cast(report_date as date) report_date, n_articles, n_valid, n_positive, n_negative,
  sent sentiment_from_yesterday, trend price_trend, hit as match, trend is not null has_price
from matched""",
)
add(
    "ticker_clean",
    ["raw_ticker_news"],
    [TICKER_ROWS],
    """
select ticker, content, title, date_published, source_url from ticker_rows
qualify row_number() over (partition by ticker, content order by date_published desc nulls last,
  source_url nulls last, title nulls last) = 1""",
)
TICKER_RUNS = (
    "ticker_runs",
    """
select r.*, cast(date '2024-01-08' + cast(doc_id % 5 as int) as date) run_date
from ticker_rows r""",
)
add(
    "ticker_clean_per_run",
    ["raw_ticker_news"],
    [TICKER_ROWS, TICKER_RUNS],
    """
select run_date, ticker, content, title, date_published, source_url from ticker_runs
qualify row_number() over (partition by run_date, ticker, content
  order by date_published desc nulls last, source_url nulls last, title nulls last) = 1""",
)
add(
    "ticker_signal_runs",
    SIGNAL_VIEWS,
    [
        TICKER_ROWS,
        TICKER_RUNS,
        ("ticker_labels", TICKER_LABELS[1].replace("from ticker_rows", "from ticker_runs")),
        (
            "report_rows",
            "select distinct ticker, run_date report_date, content, label from ticker_labels",
        ),
        VOTES,
        CHANGES,
        MATCHED,
    ],
    f"""
select {stable_id('ticker', 'report_date')} id, ticker ticker_id, sent sentiment_from_yesterday,
  round(pct, 6) price_change_in_percentage, hit as match, cast(report_date as timestamp) created_at
from matched""",
)
add(
    "undated_articles",
    ["raw_ticker_news"],
    [TICKER_ROWS],
    """
select ticker, count(*) n_undated from ticker_rows where date_published is null group by ticker""",
)
add(
    "quotes_per_run",
    ["market_ohlc"],
    [CHANGES],
    """
select cast(c.date + k.off as date) run_date, c.symbol, c.date,
  case when isfinite(m.open) then m.open end open, round(pct, 6) price_change_in_percentage,
  trend price_trend
from changes c join market_ohlc m using (symbol, date), (values (1), (2), (3)) k(off)""",
)
add(
    "article_vote",
    ["raw_ticker_news"],
    [TICKER_ROWS, TICKER_LABELS],
    """
select ticker, case when count(*) filter (label = 'negative') > count(*) filter (label = 'positive')
  then 'negative' else 'positive' end sentiment, count(*) n_articles,
  count(*) filter (label in ('positive', 'negative')) n_valid
from (select distinct ticker, content, label from ticker_labels) t group by ticker""",
)
add(
    "vote_counts",
    ["raw_ticker_news"],
    [TICKER_ROWS, TICKER_LABELS],
    """
select ticker, date_published, count(*) n_articles,
  count(*) filter (label in ('positive', 'negative')) n_valid,
  count(*) filter (label = 'positive') n_positive,
  count(*) filter (label = 'negative') n_negative
from ticker_labels group by all""",
)
add(
    "price_change",
    ["market_ohlc"],
    [CHANGES],
    "select symbol, date, round(pct, 6) price_change_in_percentage, trend price_trend from changes",
)
add(
    "prev_trading_day",
    ["market_ohlc"],
    [],
    """
select symbol, date, case dayname(date) when 'Monday' then date - 3 when 'Sunday' then date - 2
  else date - 1 end trade_date, date - 1 day_before
from market_ohlc""",
)
add(
    "report_dates",
    ["raw_ticker_news"],
    [TICKER_ROWS],
    """
select doc_id, date_published, date_published + 1 report_date from ticker_rows
where date_published is not null
union all
select doc_id, date_published, date_published + 2 from ticker_rows
where date_published is not null""",
)
add(
    "model_input",
    ["raw_ticker_news"],
    [],
    """
select doc_id,
  sha256(substr(coalesce(title, '') || ' ' || coalesce(content, ''), 1, 2000)) impact_input,
  sha256(substr(content, 1, 4000)) vote_input
from raw_ticker_news""",
)

# Sector news

COMPLETE = (
    "complete",
    """
select feed_id, sector_id, title, content, try_cast(substr(date_published, 1, 10) as date)
    date_published, trim(source_url, ' ') source_url, author, source_name, run_date
from raw_sector_news
where title is not null and content is not null and source_url is not null""",
)
IN_WINDOW = """
not coalesce(regexp_matches(date_published, '[T ]\\d{2}:\\d{2}.*(Z|[+-]\\d{2}:\\d{2})$'), false)
or try_cast(date_published as timestamptz) is null
or (try_cast(date_published as timestamptz) >=
      cast(cast(run_date - 2 as varchar) || ' 00:00:00+00' as timestamptz)
    and try_cast(date_published as timestamptz) <=
      cast(cast(run_date - 1 as varchar) || ' 23:59:59+00' as timestamptz))"""
SECTOR_ORDER = (
    "date_published desc nulls last, title nulls last, content nulls last, "
    "sector_id nulls last, author nulls last"
)
SECTOR_CLEAN = (
    "sector_clean",
    f"""
select * from complete
qualify row_number() over (partition by source_url order by {SECTOR_ORDER}) = 1""",
)


def scored(source: str) -> tuple[str, str]:
    both = "title || ' ' || content"
    return (
        "scored",
        f"""
select *, nullif(lower(regexp_extract(source_url, '^https?://(?:[^/?#]*@)?([^/:?#]+)', 1)), '')
    source_id,
  case when p + n = 0 then cast(0 as double)
    else round(cast(p - n as double) / (p + n), 4) end impact_score
from (select *, {words(both, POSITIVE)} p, {words(both, NEGATIVE)} n from {source}) s""",
    )


SECTOR_COLUMNS = "sector_id, title, content, date_published, source_url, author"

add(
    "sector_clean",
    ["raw_sector_news"],
    [COMPLETE, SECTOR_CLEAN],
    f"select {SECTOR_COLUMNS}, cast(null as varchar) source_id from sector_clean",
)
add(
    "sector_clean_per_run",
    ["raw_sector_news"],
    [COMPLETE],
    f"""
select run_date, sector_id, title, content, date_published, source_url, author,
  cast(null as varchar) source_id
from complete
qualify row_number() over (partition by run_date, source_url order by {SECTOR_ORDER}) = 1""",
)
add(
    "publish_window",
    ["raw_sector_news"],
    [],
    f"""
select feed_id, sector_id, date_published, run_date, sha256(content) content_sha2
from raw_sector_news where {IN_WINDOW}""",
)
for name, n in [("sector_head_n", 3), ("sector_head_20", 20)]:
    add(
        name,
        ["raw_sector_news"],
        [],
        f"""
select feed_id, sector_id, run_date, title, source_url, sha256(content) content_sha2
from raw_sector_news where {IN_WINDOW}
qualify row_number() over (partition by run_date, sector_id order by feed_id) <= {n}""",
    )
add(
    "impact_score",
    ["raw_sector_news"],
    [COMPLETE, SECTOR_CLEAN, scored("sector_clean")],
    f"select {SECTOR_COLUMNS}, source_id, impact_score from scored",
)
add(
    "impact_stats",
    ["raw_sector_news"],
    [COMPLETE, scored("complete")],
    """
select count(*) n_scored, round(min(impact_score), 4) min_impact,
  round(max(impact_score), 4) max_impact, round(avg(impact_score), 4) avg_impact
from scored""",
)
ARTICLE_STEPS = [
    ("windowed", f"select * from raw_sector_news where {IN_WINDOW}"),
    ("complete", COMPLETE[1].replace("raw_sector_news", "windowed")),
    (
        "first_run",
        f"""
select * from complete
qualify row_number() over (partition by source_url order by run_date, {SECTOR_ORDER}) = 1""",
    ),
    scored("first_run"),
    (
        "articles",
        f"""
select {stable_id('source_url')} sector_article_id, *,
  cast(run_date as timestamp) created_at from scored""",
    ),
]
add(
    "sector_article_table",
    ["raw_sector_news"],
    ARTICLE_STEPS,
    """
select sector_article_id, sector_id, title, content, date_published, source_url, author, source_id,
  impact_score, created_at
from articles""",
)
add(
    "union_feeds",
    ["raw_ticker_news", "raw_sector_news"],
    [],
    """
select doc_id, cast(null as bigint) feed_id, ticker, cast(null as int) sector_id, title, content,
  date_published, source_url, cast(null as varchar) author, source_name from raw_ticker_news
union all
select null, feed_id, null, sector_id, title, content, date_published, source_url, author,
  source_name
from raw_sector_news""",
)

# Payloads and columns

USED = "payload_id % 5 <> 4 and payload_id % 7 <> 3"
add(
    "payload_flatten",
    ["payload_articles"],
    [],
    f"""
select source_id, source_name, title, content, published date_published, url source_url, position,
  'NATION_' || (payload_id % 25) ticker, payload_id
from payload_articles where {USED}""",
)
add(
    "payload_flatten_sector",
    ["payload_articles"],
    [],
    f"""
select position, title, content, published date_published, url source_url, author, source_name,
  cast(payload_id % 5 + 1 as int) sector_id, payload_id
from payload_articles where {USED}""",
)
PAYLOAD_RUNS = (
    "payload_runs",
    f"""
select *, cast(date '2024-01-03' + cast(payload_id % 8 * 3 as int) as date) run_date,
  published date_published from payload_articles where {USED}""",
)
add(
    "landing_sector",
    ["payload_articles"],
    [PAYLOAD_RUNS],
    f"""
select sector_id, title, content, date_published, url source_url, author, source_name, run_date
from (select *, cast(payload_id % 5 + 1 as int) sector_id from payload_runs where {IN_WINDOW}) q
qualify row_number() over (partition by run_date, sector_id order by payload_id, position) <= 20""",
)
add(
    "landing_ticker",
    ["payload_articles"],
    [PAYLOAD_RUNS],
    f"""
select source_id, source_name, title, content, date_published, url source_url,
  'NATION_' || (payload_id % 25) ticker, run_date
from payload_runs where {IN_WINDOW}""",
)
add(
    "landing_market",
    ["payload_articles", "market_ohlc", "tickers"],
    [("daily_quotes", """
select symbol, date, case when isfinite(open) then open end open, high, low, close
from market_ohlc""")],
    """
select symbol, q.date, open, high, low, close, run_date
from daily_quotes q join (
  select distinct cast(date '2024-01-03' + cast(payload_id % 8 * 3 as int) as date) run_date
  from payload_articles) r
on q.date = run_date - case isodow(run_date) when 1 then 3 when 7 then 2 else 1 end
where symbol in (select ticker_id from tickers)""",
)
add(
    "payload_outcomes",
    ["payload_articles"],
    [],
    """
select case when payload_id % 5 = 4 then 'error' when payload_id % 7 = 3 then 'empty'
  else 'used' end outcome, count(distinct payload_id) n_payloads
from payload_articles group by 1""",
)
add(
    "alias_align",
    ["raw_ticker_news"],
    [],
    """
select doc_id, ticker, content, title,
  try_cast(substr(date_published, 1, 10) as date) date_published, source_url
from raw_ticker_news""",
)
add(
    "lenient_projection",
    ["market_ohlc"],
    [],
    'select date, symbol "Ticker", close "Last" from market_ohlc',
)

# Prices

add(
    "quote_on_date",
    ["price_ticks"],
    [],
    """
select symbol, date '2024-01-05' as date, open, high, low, close from price_ticks
where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-06'
qualify row_number() over (partition by symbol order by ts, open, high, low, close) = 1""",
)
DAILY_QUOTES = (
    "daily_quotes",
    """
select symbol, date, case when isfinite(open) then open end open, high, low, close
from market_ohlc""",
)
add(
    "latest_quote",
    ["market_ohlc"],
    [DAILY_QUOTES],
    """
select symbol, date, open, high, low, close from daily_quotes
where date > date '2024-01-25' and date <= date '2024-01-30'
qualify row_number() over (partition by symbol order by date desc) = 1""",
)
add(
    "quotes_for_universe",
    ["market_ohlc", "tickers"],
    [DAILY_QUOTES],
    """
select symbol, date, open, high, low, close from daily_quotes
where symbol in (select ticker_id from tickers)""",
)

# Sources

PAGE_HOST = "lower(regexp_extract(url, '^https?://(?:[^/?#]*@)?([^/:?#]+)', 1))"
add(
    "hosts",
    ["page_urls"],
    [],
    f"select page_id, {PAGE_HOST} as host, nullif({PAGE_HOST}, '') source_id from page_urls",
)
# Two suffixes of two labels occur among the probed hosts: co.uk and gov.sg.
REGISTERED = (
    "case when regexp_matches(source_id, '(^|[.])(co[.]uk|gov[.]sg)$') "
    "then regexp_extract(source_id, '([^.]+[.])?[^.]+[.][^.]+$') "
    "else regexp_extract(source_id, '([^.]+[.])?[^.]+$') end"
)
VALID = "regexp_matches(registered, '^([a-z0-9]([a-z0-9-]*[a-z0-9])?[.])+[a-z]{2,}$')"
add(
    "registered_domain",
    ["source_probe"],
    [],
    f"""
select source_id, registered, {VALID} as valid
from (select distinct source_id, {REGISTERED} registered from source_probe) h""",
)
add(
    "registered_domain_rules",
    ["suffix_hosts"],
    [],
    """
select host, registered,
  regexp_matches(registered, '^([\\p{L}0-9]([\\p{L}0-9-]*[\\p{L}0-9])?[.])+\\p{L}{2,}$') as valid
from (
  select host, case
      when regexp_matches(host, '^[0-9.]+$') then host
      when regexp_matches(host, '[.]www[.]ck$') then 'www.ck'
      when regexp_matches(host, '(^|[.])[^.]+[.]ck$')
        then regexp_extract(host, '([^.]+[.])?[^.]+[.]ck$')
      when regexp_matches(host, '(^|[.])k12[.]ca[.]us$')
        then regexp_extract(host, '([^.]+[.])?k12[.]ca[.]us$')
      when regexp_matches(host, '(^|[.])(ca[.]us|com[.]pe)$')
        then regexp_extract(host, '([^.]+[.])?[^.]+[.][^.]+$')
      else regexp_extract(host, '([^.]+[.])?[^.]+$') end registered
  from suffix_hosts) q""",
)
ORACLE["registered_domain_table"] = ORACLE["registered_domain_rules"]
add(
    "distinct_sources",
    ["raw_sector_news"],
    [],
    """
select distinct lower(regexp_extract(trim(source_url), '^https?://([^/:?#]+)', 1)) source_id
from raw_sector_news where source_url is not null""",
)


def pattern(names: list[str]) -> str:
    """A pattern that finds one of the names; dots are the only special characters in them."""
    return "|".join(n.replace(".", "[.]") for n in names)


def features(source: str, as_of: str = "date '2024-02-01'") -> list[tuple[str, str]]:
    inst = "regexp_matches(registered, '[.](gov|edu|mil|org|gov[.]sg)$')"
    comm = "regexp_matches(registered, '[.](com|co|net)$')"
    age = (
        "coalesce(greatest(0e0, least(1e0, ln(1 + greatest(0, "
        f"{as_of} - creation_date)) / ln(9126e0))), 0e0)"
    )
    unread = (
        "(article_text is null or polarity is null or isnan(polarity) "
        "or length(article_text) < 300)"
    )
    sites, trusted = pattern(UGC_SITES), pattern(TRUSTED_SOURCES)
    phrases = pattern([p.lower() for p in UGC_PHRASES])
    return [
        ("named", f"select *, {REGISTERED} registered from {source}"),
        (
            "features",
            f"""
select *, case when {VALID} then 1e0 else 0e0 end domain_valid,
  case when status_code is null then 0e0 else 1e0 end https,
  case when status_code is null then 0e0 when status_code in (200, 301, 302, 403) then 1e0
    else 0.5e0 end status,
  case when status_code is null or elapsed_s is null or isnan(elapsed_s) then 0e0
    else greatest(0e0, least(1e0, (5e0 - elapsed_s) / 5e0)) end response_time,
  case when {inst} then 1e0 when {comm} then greatest({age}, 0.9e0) else {age} end domain_age,
  case when {unread} then 0.8e0 else greatest(0.7e0, 1 - abs(polarity)) end neutrality,
  case when {unread} then 0.8e0
    else greatest(0e0, least(1e0, (length(article_text) - 300) / 1700e0)) end text_len,
  least(1e0, case when regexp_matches(source_id, '{sites}') then 0.7e0 else 0e0 end
    + case when status_code is not null and html is not null
        and regexp_matches(lower(html), '{phrases}') then 0.3e0 else 0e0 end) ugc_score,
  {inst} institution, regexp_matches(source_id, '{trusted}') trusted
from named""",
        ),
        (
            "totals",
            """
select *, (0.1e0 * domain_valid + 0.1e0 * https + 0.15e0 * status + 0.1e0 * response_time
  + 0.35e0 * domain_age + 0.05e0 * neutrality + 0.05e0 * text_len - 0.3e0 * ugc_score) * 100
  + case when trusted then 15 else 0 end + case when institution then 10 else 0 end total
from features""",
        ),
        (
            "scores",
            """
select *, round(greatest(0e0, least(100e0, case when domain_age > 0.8e0 and ugc_score < 0.5e0
  then greatest(total, 85e0) else total end)), 2) reliability_score
from totals""",
        ),
    ]


RATING = "case when {s} >= 86 then 'A' when {s} > 55 then 'B' else 'C' end"
PROBE_STEPS = features("source_probe")
MEAN_SCORES = (
    "rated",
    f"""
select *, {RATING.format(s='credibility_score')} rating from (
  select source_id, round(avg(reliability_score), 2) credibility_score
  from scores group by source_id) m""",
)
FEATURE_NAMES = [
    "domain_valid", "https", "status", "response_time", "domain_age", "neutrality", "text_len",
    "ugc_score",
]
add(
    "source_features",
    ["source_probe"],
    PROBE_STEPS,
    "select source_id, registered, "
    + ", ".join(f"round({f}, 6) {f}" for f in FEATURE_NAMES)
    + " from features",
)
add(
    "source_score",
    ["source_probe"],
    PROBE_STEPS,
    f"""
select source_id, reliability_score, {RATING.format(s='reliability_score')} rating from scores""",
)
add(
    "source_rating",
    ["raw_sector_news", "source_probe"],
    [
        (
            "wanted",
            """
select distinct lower(regexp_extract(trim(source_url), '^https?://([^/:?#]+)', 1)) source_id
from raw_sector_news where source_url is not null""",
        ),
        ("observed", "select * from wanted left join source_probe using (source_id)"),
        *features("observed"),
        MEAN_SCORES,
    ],
    "select source_id, credibility_score, rating, date '2024-02-01' last_verified from rated",
)
add(
    "source_rating_first_run",
    ["raw_sector_news", "source_probe"],
    [
        (
            "wanted",
            """
select lower(regexp_extract(trim(source_url), '^https?://([^/:?#]+)', 1)) source_id,
  min(run_date) as_of
from raw_sector_news where source_url is not null group by 1""",
        ),
        ("observed", "select * from wanted left join source_probe using (source_id)"),
        *features("observed", "as_of"),
        (
            "rated",
            """
select source_id, round(avg(reliability_score), 2) credibility_score, min(as_of) last_verified
from scores group by source_id""",
        ),
    ],
    f"""
select source_id, credibility_score, {RATING.format(s='credibility_score')} rating,
  cast(last_verified as date) last_verified from rated""",
)
add(
    "rating_distribution",
    ["source_probe"],
    [*PROBE_STEPS, MEAN_SCORES],
    "select rating, count(*) n_sources from rated group by rating",
)
add(
    "credibility_stats",
    ["source_probe"],
    [*PROBE_STEPS, MEAN_SCORES],
    """
select count(*) n_sources, round(avg(credibility_score), 2) avg_score,
  min(credibility_score) min_score, max(credibility_score) max_score
from rated""",
)

# Merges, dimensions, constraints

MERGE_STEPS = [
    (
        "slots",
        """
select ticker_id || strftime(created_at, ' %d %H') slot, ticker_article_id,
  price_change_in_percentage, match, created_at
from signals""",
    ),
    (
        "target",
        """
select * from slots where created_at < timestamp '2024-01-11'
qualify row_number() over (partition by slot order by ticker_article_id) = 1""",
    ),
    (
        "batch",
        """
select slot, ticker_article_id, price_change_in_percentage, created_at from slots
where created_at >= timestamp '2024-01-06'
qualify row_number() over (partition by slot order by ticker_article_id desc) = 1""",
    ),
]
INSERTED = """
select slot, ticker_article_id, price_change_in_percentage, cast(null as boolean) as match,
  created_at
from batch where slot not in (select slot from target)"""
add(
    "upsert_nothing", ["signals"], MERGE_STEPS, f"select * from target union all {INSERTED}"
)
add(
    "upsert_update",
    ["signals"],
    MERGE_STEPS,
    f"""
select t.slot, case when b.slot is null then t.ticker_article_id else b.ticker_article_id end
    ticker_article_id,
  case when b.slot is null then t.price_change_in_percentage
    else b.price_change_in_percentage end price_change_in_percentage, t.match,
  case when b.slot is null then t.created_at else b.created_at end created_at
from target t left join batch b on b.slot = t.slot
union all {INSERTED}""",
)
# The same merges into a stored table, which is then read back.
ORACLE["upsert_stored_nothing"] = ORACLE["upsert_nothing"]
ORACLE["upsert_stored_update"] = ORACLE["upsert_update"]
add(
    "latest_per_day",
    ["signals"],
    [],
    """
select * from signals qualify row_number() over (partition by ticker_id, cast(created_at as date)
  order by created_at desc, ticker_article_id desc) = 1""",
)
add(
    "latest_per_ticker",
    ["signals"],
    [],
    """
select * from signals qualify row_number() over (partition by ticker_id
  order by created_at desc, ticker_article_id desc) = 1""",
)
add(
    "seed_dims",
    ["sectors", "tickers", "market_ohlc"],
    [],
    """
select t.ticker_id, t.sector_id, s.sector_name, d.n_days
from tickers t join sectors s on s.sector_id = t.sector_id
left join (select symbol, count(*) n_days from market_ohlc group by symbol) d
  on d.symbol = t.ticker_id""",
)
add(
    "fk_orphans",
    ["signals", "tickers"],
    [],
    """
select s.ticker_id fk_value, count(*) n_rows from signals s
where s.ticker_id is not null
  and not exists (select 1 from tickers t where t.ticker_id = s.ticker_id)
group by 1""",
)
add(
    "pk_duplicates",
    ["raw_sector_news"],
    [],
    """
select source_url, count(*) n_rows from raw_sector_news where source_url is not null
group by 1 having count(*) > 1""",
)
add(
    "constraint_violations",
    ["sectors", "tickers", "raw_sector_news", "signals"],
    [
        (
            "found",
            """
select 'unique' "check", 'sector_article' table_name, 'sector_article_id' columns,
  (select coalesce(sum(c), 0) from (select count(*) c from raw_sector_news
    group by feed_id % 900 having count(*) > 1) g) n_rows
union all
select 'unique', 'sector_article', 'source_url', (select coalesce(sum(c), 0) from (
  select count(*) c from raw_sector_news where source_url is not null group by source_url
  having count(*) > 1) g)
union all
select 'foreign_key', 'ticker_article', 'ticker_id', (select count(*) from signals
  where ticker_id not in (select ticker_id from tickers))""",
        )
    ],
    """
select "check", table_name, columns, cast(n_rows as bigint) n_rows from found where n_rows > 0""",
)
add(
    "quality_counters",
    ["raw_sector_news"],
    [COMPLETE, SECTOR_CLEAN, scored("sector_clean")],
    """
select rows_in, rows_in - complete_rows rows_dropped, complete_rows - rows_out duplicates_removed,
  missing_ids, rows_out
from (select (select count(*) from raw_sector_news) rows_in,
  (select count(*) from complete) complete_rows, (select count(*) from scored) rows_out,
  (select count(*) from scored where source_id is null) missing_ids) c""",
)
add(
    "stable_ids",
    ["signals"],
    [],
    f"""
select ticker_article_id,
  {stable_id('ticker_id', 'sentiment_from_yesterday', 'ticker_article_id')} id
from signals""",
)

# Reports

SIGNAL_VIEW = (
    "signal_view",
    """
select s.ticker_article_id, s.ticker_id stock_ticker,
  case when sentiment_from_yesterday then 'Positive'
    when not sentiment_from_yesterday then 'Negative' end sentiment_from_yesterday,
  price_change_in_percentage, match, created_at, sector_name
from signals s left join tickers t on t.ticker_id = s.ticker_id
left join sectors c on c.sector_id = t.sector_id""",
)
LATEST = (
    "latest",
    """
select * from signal_view qualify row_number() over (
  partition by stock_ticker, cast(created_at as date)
  order by created_at desc, ticker_article_id desc) = 1""",
)
ARTICLE_VIEW = (
    "article_view",
    """
select a.*, c.sector_name from articles a left join sectors c on c.sector_id = a.sector_id
where impact_score is not null""",
)
DIMS = ["signals", "tickers", "sectors"]
SCORE = (
    "case when sentiment_from_yesterday = 'Positive' then 1 "
    "when sentiment_from_yesterday = 'Negative' then -1 else 0 end"
)


def sign(x: str) -> str:
    return (
        f"case when {x} is null then 'unknown' when {x} > 0 then 'up' when {x} < 0 then 'down' "
        "else 'flat' end"
    )


def escaped(x: str) -> str:
    for char, entity in [
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;"),
    ]:
        x = f"replace({x}, '{char}', '{entity}')"
    return x


LINK = (
    f"'<a href=''' || {escaped('source_url')} || ''' target=''_blank''>' || "
    f"{escaped('title')} || '</a>'"
)
KPIS = f"""round(avg({SCORE}), 6) avg_sentiment,
  round(avg(price_change_in_percentage), 6) avg_price_change, count(*) n_tickers,
  count(*) filter (sentiment_from_yesterday = 'Negative') n_negative,
  {sign(f'avg({SCORE})')} sentiment_sign, {sign('avg(price_change_in_percentage)')} price_sign"""
SUMMARY = f"""count(ticker_article_id) article_count, round(avg({SCORE}), 6) avg_sentiment,
  round(avg(price_change_in_percentage), 6) avg_price_change"""

add("ticker_articles_view", DIMS, [SIGNAL_VIEW], "select * from signal_view")
add(
    "ticker_articles_recent",
    DIMS,
    [SIGNAL_VIEW],
    "select * from signal_view order by created_at desc nulls first, ticker_article_id limit 2000",
)
add(
    "ticker_articles_every",
    DIMS,
    [SIGNAL_VIEW],
    "select * from signal_view order by created_at desc nulls first, ticker_article_id",
)
add(
    "sector_articles_view",
    ["raw_sector_news", "sectors"],
    [*ARTICLE_STEPS, ARTICLE_VIEW],
    """
select sector_article_id, title, content, impact_score, date_published, source_url, created_at,
  sector_name
from article_view order by date_published desc nulls first, sector_article_id""",
)
add(
    "kpi_daily",
    DIMS,
    [SIGNAL_VIEW, LATEST],
    f"select cast(created_at as date) report_date, {KPIS} from latest group by 1",
)
add(
    "ticker_summary",
    DIMS,
    [SIGNAL_VIEW, LATEST],
    f"""
select cast(created_at as date) report_date, stock_ticker, {SUMMARY}
from latest where sentiment_from_yesterday = 'Positive' group by 1, 2""",
)
add(
    "ticker_detail",
    DIMS,
    [SIGNAL_VIEW, LATEST],
    f"""
select stock_ticker ticker, sentiment_from_yesterday sentiment,
  round(price_change_in_percentage, 6) price_change, match matched,
  strftime(created_at, '%Y-%m-%d %H:%M') created_at,
  {sign('round(price_change_in_percentage, 6)')} direction
from latest""",
)
IMPACT_ORDER = "impact_score desc nulls last, date_published desc nulls last, sector_article_id"
add(
    "top_articles",
    ["raw_sector_news", "sectors"],
    [*ARTICLE_STEPS, ARTICLE_VIEW],
    f"""
select date_published + 1 report_date, {LINK} article, impact_score impact, sector_name sector,
  strftime(date_published, '%Y-%m-%d') published
from article_view where date_published is not null
qualify row_number() over (partition by date_published order by {IMPACT_ORDER}) <= 5""",
)
DAY = (
    "day_latest",
    """
select * from signal_view where sector_name in ('asia', 'europe')
  and cast(created_at as date) = date '2024-01-17'
qualify row_number() over (partition by stock_ticker
  order by created_at desc, ticker_article_id desc) = 1""",
)
add("report_kpis", DIMS, [SIGNAL_VIEW, DAY], f"select {KPIS} from day_latest")
add(
    "report_summary",
    DIMS,
    [SIGNAL_VIEW, DAY],
    f"""
select stock_ticker, {SUMMARY} from day_latest where sentiment_from_yesterday = 'Negative'
group by 1""",
)
add(
    "report_detail",
    DIMS,
    [SIGNAL_VIEW, DAY],
    """
select stock_ticker ticker, sentiment_from_yesterday sentiment,
  round(price_change_in_percentage, 6) price_change, match matched,
  strftime(created_at, '%Y-%m-%d %H:%M') created_at
from day_latest where stock_ticker = 'NATION_12'""",
)
add(
    "report_top_articles",
    ["raw_sector_news", "sectors"],
    [*ARTICLE_STEPS, ARTICLE_VIEW],
    f"""
select {LINK} article, impact_score impact, sector_name sector,
  strftime(date_published, '%Y-%m-%d') published
from article_view where sector_name in ('asia', 'europe') and date_published = date '2024-01-16'
order by {IMPACT_ORDER} limit 5""",
)
DAY_ALL = (
    "day_all",
    """
select * from signal_view where cast(created_at as date) = date '2024-01-17'
  and stock_ticker is not null
qualify row_number() over (partition by stock_ticker
  order by created_at desc, ticker_article_id desc) = 1""",
)
add(
    "report_summary_tickers",
    DIMS,
    [SIGNAL_VIEW, DAY_ALL],
    f"""
select stock_ticker, {SUMMARY} from day_all
where stock_ticker in ('NATION_1', 'NATION_12', 'NATION_20', 'UNLISTED') group by 1""",
)
add(
    "report_summary_all",
    DIMS,
    [SIGNAL_VIEW, DAY_ALL],
    f"""
select stock_ticker, {SUMMARY} from day_all
where sector_name is not null and sentiment_from_yesterday is not null group by 1""",
)
add(
    "report_kpis_all",
    DIMS,
    [SIGNAL_VIEW, DAY_ALL],
    f"select {KPIS} from day_all where sector_name is not null",
)
for name in ["date_bounds", "date_bounds_stored"]:
    add(
        name,
        ["signals", "raw_sector_news"],
        ARTICLE_STEPS,
        """
select min(day) min_date, max(day) max_date from (
  select cast(created_at as date) as day from signals
  union all select date_published from articles) d""",
    )
add(
    "filter_options",
    DIMS,
    [SIGNAL_VIEW],
    "select distinct sector_name option from signal_view where sector_name is not null",
)
add(
    "ticker_options",
    DIMS,
    [SIGNAL_VIEW],
    """
select distinct stock_ticker option from signal_view
where sector_name = 'asia' and stock_ticker is not null""",
)

# History of signals and prices

TRADING_DAYS = (
    "trading_days",
    "select * from market_ohlc where day(date) not in (4, 5, 9, 15, 22, 23, 24)",
)
add(
    "quotes_as_of",
    ["signals", "market_ohlc"],
    [TRADING_DAYS],
    """
select symbol, cast(day as date) as day, date, case when isfinite(open) then open end as open,
  case when isfinite(high) then high end as high, case when isfinite(low) then low end as low,
  case when isfinite(close) then close end as close
from (select distinct ticker_id, cast(created_at as date) as day from signals) w
asof join trading_days t on t.symbol = w.ticker_id and w.day >= t.date
where date > day - 3""",
)
add(
    "signal_match_holidays",
    SIGNAL_VIEWS,
    [TICKER_ROWS, TICKER_LABELS, REPORT_ROWS, VOTES, TRADING_DAYS,
     ("changes", CHANGES[1].replace("market_ohlc", "trading_days"))],
    """
select v.ticker, cast(v.report_date as date) report_date,
  n_positive >= n_negative sentiment_from_yesterday, c.trend price_trend,
  coalesce((n_positive >= n_negative) = (c.trend = 'positive'), false) as match,
  c.trend is not null has_price
from (select *, report_date - case isodow(report_date) when 1 then 3 when 7 then 2 else 1 end as d
  from report_votes) v
left join changes c on c.symbol = v.ticker and c.date = (
  select max(x.date) from changes x where x.symbol = v.ticker and x.date <= v.d and x.date > v.d - 3)""",
)
SCORED = (
    "scored",
    """
select s.*, t.sector_id, case when sentiment_from_yesterday then 1 when not
  sentiment_from_yesterday then -1 end as score
from signals s left join tickers t using (ticker_id)""",
)
add(
    "sentiment_decayed",
    ["signals", "tickers"],
    [
        SCORED,
        (
            "daily",
            """
select 'ticker' as level, ticker_id as key, cast(created_at as date) as day, count(*) as n,
  sum(score) as total from scored where score is not null group by all
union all
select 'sector', cast(sector_id as varchar), cast(created_at as date), count(*), sum(score)
from scored where score is not null group by all""",
        ),
    ],
    """
select d.level, d.key, d.day, d.n, round(sum(e.n * power(0.5, (d.day - e.day) / 7.0)), 6) as weight,
  round(sum(cast(e.total as double) * power(0.5, (d.day - e.day) / 7.0))
    / sum(e.n * power(0.5, (d.day - e.day) / 7.0)), 6) as score
from daily d join daily e on e.level = d.level and e.key is not distinct from d.key and e.day <= d.day
group by d.level, d.key, d.day, d.n""",
)
add(
    "rolling_hit_rate",
    ["signals"],
    [],
    """
select ticker_article_id, ticker_id, row_number() over w - 1 as position,
  round(avg(cast(match as int)) over (partition by ticker_id order by created_at,
    ticker_article_id rows between 4 preceding and current row), 9) as rate_5,
  round(avg(cast(match as int)) over (partition by ticker_id order by created_at,
    ticker_article_id rows between 59 preceding and current row), 9) as rate_60
from signals where ticker_id is not null and created_at is not null
window w as (partition by ticker_id order by created_at, ticker_article_id)""",
)
DAILY_SIDES = [
    SCORED,
    (
        "mean",
        """
select ticker_id, cast(created_at as date) as day, sum(score) / cast(count(*) as double) sentiment
from scored where score is not null group by all""",
    ),
    CHANGES,
    ("moves", "select symbol as ticker_id, date as day, pct as change from changes"),
]
add(
    "lagged_correlation",
    ["signals", "tickers", "market_ohlc"],
    [
        *DAILY_SIDES,
        (
            "pairs",
            """
select m.ticker_id, cast(k.lag as int) as lag, sentiment x, change y
from mean m, (select unnest(range(-5, 6)) as lag) k
join moves c on c.ticker_id = m.ticker_id and c.day = m.day + cast(k.lag as int)
where change is not null""",
        ),
        (
            "sums",
            """
select ticker_id, lag, count(*) as n, case when count(*) >= 3 and min(x) < max(x)
  and min(y) < max(y) then corr(x, y) end as r from pairs group by all""",
        ),
    ],
    """
select ticker_id, lag, n, round(r, 6) as r,
  round(case when abs(r) < 1 then r * sqrt((n - 2) / (1 - r * r)) end, 6) as t from sums""",
)
_SLOPE = """round(case when count({y}) over {w} >= 2 then regr_slope({y}, datediff('day',
  date '2024-01-01', day)) over {w} end, 6) as slope_{y}_{k}"""
add(
    "trend_slopes",
    ["signals", "tickers", "market_ohlc"],
    [
        *DAILY_SIDES,
        (
            "both_sides",
            "select ticker_id, day, sentiment, change from mean full join moves using (ticker_id, day)",
        ),
    ],
    "select ticker_id, cast(day as date) as day, round(sentiment, 6) as sentiment, "
    "round(change, 6) as change, "
    + ", ".join(_SLOPE.format(y=y, k=k, w=f"w{k}") for y in ("sentiment", "change") for k in (7, 21))
    + " from both_sides window "
    + ", ".join(
        f"w{k} as (partition by ticker_id order by day range between interval {k - 1} days "
        "preceding and current row)" for k in (7, 21)
    ),
)
add(
    "change_points",
    ["signals", "tickers", "market_ohlc"],
    [
        *DAILY_SIDES,
        (
            "z",
            """
select ticker_id, day, sentiment, row_number() over (partition by ticker_id order by day) i,
  (sentiment - avg(sentiment) over p) / nullif(stddev_pop(sentiment) over p, 0) as z
from mean window p as (partition by ticker_id)""",
        ),
        # The sums that start anew at zero, day by day.
        (
            "walk",
            """
select ticker_id, day, sentiment, i, greatest(0, coalesce(z - 0.25e0, 0)) as rise,
  greatest(0, coalesce(-z - 0.25e0, 0)) as fall from z where i = 1
union all
select z.ticker_id, z.day, z.sentiment, z.i, greatest(0, walk.rise + coalesce(z.z - 0.25e0, 0)),
  greatest(0, walk.fall + coalesce(-z.z - 0.25e0, 0))
from walk join z on z.ticker_id = walk.ticker_id and z.i = walk.i + 1""",
        ),
    ],
    """
select ticker_id, day, round(sentiment, 6) as sentiment, round(rise, 6) as rise,
  round(fall, 6) as fall, (rise > 2 or fall > 2) and not coalesce(lag(rise > 2 or fall > 2)
    over (partition by ticker_id order by day), false) as change
from walk""",
)
ORACLE["change_points"] = ORACLE["change_points"].replace("with ", "with recursive ", 1)
