"""Input views over the given tables, as SQL that Spark and DuckDB both read.

Each view spans its whole table. Rows are turned into feed rows by arithmetic on their
ids, which spreads missing values, padding, bad dates and duplicates over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tapewire.sources.readers import read_parquet

# Columns of the given tables that the views read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

# The numbers 0 to 3 as rows beside each input row.
FOUR = {"spark": "explode(array(0, 1, 2, 3))", "duckdb": "unnest([0, 1, 2, 3])"}

# The publish day of a document; with 25 tickers every ticker meets every day.
_DOC_DAY = "cast(1 + cast(floor(d.doc_id / 25) as bigint) % 30 as int)"
_NEWLINE = chr(10)
_DOC_ISO = f"'2024-01-' || lpad(cast({_DOC_DAY} as string), 2, '0')"
_PAGE_DAY = "cast(1 + page_id % 30 as int)"
_PAGE_ISO = f"'2024-01-' || lpad(cast({_PAGE_DAY} as string), 2, '0')"

VIEWS: dict[str, tuple[list[str], str]] = {
    "sectors": (
        ["region"],
        "select cast(r_regionkey + 1 as int) sector_id, lower(r_name) sector_name from {region}",
    ),
    "tickers": (
        ["nation"],
        "select n_name ticker_id, cast(n_regionkey + 1 as int) sector_id from {nation}",
    ),
    "price_ticks": (
        ["events"],
        """
select 'NATION_' || cast(user_id % 25 as string) symbol, ts, event_id,
  value open, value + 1 high, value - 1 low, value * 1.5e0 as close
from {events}""",
    ),
    "market_ohlc": (
        ["events"],
        """
select symbol, date,
  case when (length(symbol) + day(date)) % 11 = 0 then cast(0 as double)
    when (length(symbol) + day(date)) % 17 = 0 then cast('Infinity' as double)
    when (length(symbol) + day(date)) % 19 = 0 then cast('NaN' as double) else open end open,
  high, low,
  case when (length(symbol) + day(date)) % 13 = 0 then null else close end as close
from (
  select case when event_id % 97 = 0 then 'UNLISTED'
      else 'NATION_' || cast(user_id % 25 as string) end symbol, cast(ts as date) date,
    min_by(value, event_id) open, max(value) high, min(value) low,
    max_by(value, event_id) as close
  from {events} group by 1, 2) q""",
    ),
    # News per ticker: one row per document.
    "raw_ticker_news": (
        ["documents"],
        f"""
select d.doc_id,
  case when d.doc_id % 13 = 0 then null
       when d.doc_id % 7 = 0 then ' nation_' || cast(d.doc_id % 25 as string) || ' '
       else 'NATION_' || cast(d.doc_id % 25 as string) end ticker,
  case when d.doc_id % 11 = 0 then null when d.doc_id % 17 = 0 then ''
       when d.doc_id % 37 = 0 then '  ' when d.doc_id % 41 = 0 then ' NaN '
       else d.text end content,
  regexp_extract(d.text, '^[^{_NEWLINE}]*', 0) title,
  case when d.doc_id % 19 = 0 then 'n/a' when d.doc_id % 5 = 0 then {_DOC_ISO}
       else {_DOC_ISO} || 'T14:00:00Z' end date_published,
  'https://' || d.source || '.example.com/' || cast(d.doc_id as string) source_url,
  d.source source_name
from {{documents}} d""",
    ),
    # News per sector: every page lands in three runs, and twice in the second of them.
    "raw_sector_news": (
        ["pages"],
        f"""
select page_id * 4 + k feed_id,
  cast(1 + cast(floor(page_id / 30) as bigint) % 5 as int) sector_id,
  case when page_id % 29 = 0 then null
       else regexp_extract(html, '<title>([^<]*)</title>', 1) || ' v' || cast(k as string)
       end title,
  case when page_id % 11 = 0 then null else html end content,
  case when page_id % 19 = 0 then 'n/a' when page_id % 31 = 0 then null
       when page_id % 5 = 0 then {_PAGE_ISO}
       when page_id % 8 = 0 then {_PAGE_ISO} || 'T23:59:59Z'
       when page_id % 8 = 1 then {_PAGE_ISO} || 'T00:00:00Z'
       when page_id % 8 = 2 then {_PAGE_ISO} || 'T23:59:59.500Z'
       when page_id % 8 = 3 then {_PAGE_ISO} || 'T01:30:00+09:00'
       else {_PAGE_ISO} || 'T14:00:00Z' end date_published,
  case when page_id % 23 = 0 then null when k = 3 then '  ' || url || ' ' else url end source_url,
  case when page_id % 10 = 0 then null else 'desk ' || cast(page_id % 7 as string) end author,
  'Name ' || cast(page_id % 4 as string) source_name,
  cast('2024-01-01' as date) + cast({_PAGE_DAY} + case k when 3 then 1 else k end as int) run_date
from (select page_id, url, html, {{four}} k from {{pages}}) q""",
    ),
    "page_urls": (["pages"], "select page_id, url from {pages}"),
    # Hosts under suffixes of three labels, wildcard rules, exceptions and unlisted suffixes.
    "suffix_hosts": (
        ["pages"],
        """
select distinct case page_id % 10 when 0 then 'www.city' || cast(page_id % 7 as string) || '.k12.ca.us'
    when 1 then 'a.b' || cast(page_id % 7 as string) || '.co.ck' when 2 then 'x.www.ck'
    when 3 then 'www.abc' || cast(page_id % 7 as string) || '.com.pe' when 4 then 'news.münchen.de'
    when 5 then 'k12.ca.us' when 6 then '10.1.2.' || cast(page_id % 7 as string)
    when 7 then 'la.ca.us' when 8 then 'x' || cast(page_id % 7 as string) || '.unlisted.zz'
    else lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) end host
from {pages}""",
    ),
    "payload_articles": (
        ["pages"],
        """
select cast(floor(page_id / 20) as bigint) payload_id, cast(page_id % 20 as int) position,
  case when page_id % 6 = 0 then null else 'src' || cast(page_id % 4 as string) end source_id,
  'Name ' || cast(page_id % 4 as string) source_name,
  case when page_id % 10 = 0 then null else 'desk' end author,
  'Page ' || cast(page_id as string) title, html content, url,
  '2024-01-' || lpad(cast(1 + page_id % 28 as string), 2, '0') || 'T08:00:00Z' published
from {pages}""",
    ),
    "source_probe": (
        ["pages"],
        """
select case page_id % 16 when 0 then 'en.wikipedia.org' when 1 then 'www.reuters.com'
    when 2 then 'www.mom.gov.sg' when 3 then 'news.bbc.co.uk' when 4 then 'old.reddit.com'
    when 5 then 'slow.example.xyz' when 6 then 'store.microsoft.com' when 7 then 'bad_host'
    else lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) end source_id,
  cast(case page_id % 7 when 0 then null when 1 then 404 when 2 then 403 else 200 end as int)
    status_code,
  case when page_id % 13 = 0 then null when page_id % 17 = 0 then cast('NaN' as double)
    else cast(page_id % 60 as double) / 10 end elapsed_s,
  case when page_id % 9 = 0 then null when page_id % 8 = 0 then html || ' EDIT this page'
    else html end html,
  case when page_id % 5 = 0 then null
    else cast('2024-02-01' as date) - cast(page_id * 137 % 12000 as int) end creation_date,
  case when page_id % 6 = 0 then null when page_id % 6 = 1 then url
    when page_id % 6 = 2 then url || url || url || url || url || url || url || url || url || url
    else html end article_text,
  case when page_id % 14 = 0 then null when page_id % 15 = 1 then cast('NaN' as double)
    else cast(page_id % 21 - 10 as double) / 10 end polarity
from {pages}""",
    ),
    "signals": (
        ["events"],
        """
select event_id ticker_article_id,
  case when event_id % 97 = 0 then 'UNLISTED' else 'NATION_' || cast(user_id % 25 as string) end
    ticker_id,
  case when event_id % 13 = 0 then null else event_id % 3 <> 0 end sentiment_from_yesterday,
  case when event_id % 17 = 0 then null else value - 50 end price_change_in_percentage,
  event_id % 4 = 1 as match, ts created_at
from {events}""",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", T.StructType.fromDDL(TABLES[name]))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bases, sql = VIEWS[name]
    tables = {base: table(spark, sf_dir, base) for base in bases}
    return spark.sql(sql.replace("{four}", FOUR["spark"]), **tables)


def cte(*names: str) -> str:
    """The views as a WITH clause over the registered tables."""
    parts = []
    for name in names:
        bases, sql = VIEWS[name]
        text = sql.format(four=FOUR["duckdb"], **{b: b for b in bases})
        parts.append(f"{name} as ({text})")
    return "with " + ",\n".join(parts)
