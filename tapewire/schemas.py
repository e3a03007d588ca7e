"""Explicit schemas for every table the library reads or writes.

Reads never infer: inference costs an extra pass over the files, and a column that
is absent or all null on one day must not change the schema.
"""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


STR, INT, DBL, BOOL = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampNTZType()

# The column names of all tables below.

# Landed feeds
PAYLOAD_ARTICLE = _struct(
    source=_struct(id=STR, name=STR),
    author=STR,
    title=STR,
    content=STR,
    url=STR,
    publishedAt=STR,
)
NEWS_PAYLOAD = _struct(status=STR, message=STR, articles=T.ArrayType(PAYLOAD_ARTICLE))
RAW_TICKER_NEWS = _struct(
    source_id=STR,
    source_name=STR,
    title=STR,
    content=STR,
    date_published=STR,
    source_url=STR,
    ticker=STR,
)
RAW_SECTOR_NEWS = _struct(
    sector_id=INT,
    title=STR,
    content=STR,
    date_published=STR,
    source_url=STR,
    author=STR,
    source_name=STR,
)
MARKET_OHLC = _struct(symbol=STR, date=DATE, open=DBL, high=DBL, low=DBL, close=DBL)
SOURCE_PROBE = _struct(
    source_id=STR,
    status_code=INT,
    elapsed_s=DBL,
    html=STR,
    creation_date=DATE,
    article_text=STR,
    polarity=DBL,
)

# Curated feeds
TICKER_CLEAN = _struct(ticker=STR, content=STR, title=STR, date_published=DATE, source_url=STR)
SECTOR_CLEAN = _struct(
    sector_id=INT,
    title=STR,
    content=STR,
    date_published=DATE,
    source_url=STR,
    author=STR,
    source_id=STR,
)


def with_run_date(schema: T.StructType) -> T.StructType:
    """A table that is partitioned by run date."""
    return T.StructType([*schema.fields, T.StructField("run_date", DATE, True)])


# Warehouse tables. Surrogate ids are content-derived strings (see functions.ids),
# so that re-running a day yields the same ids on any cluster.
SECTORS = _struct(sector_id=INT, sector_name=STR)
TICKERS = _struct(ticker_id=STR, sector_id=INT)
SOURCES = _struct(source_id=STR, credibility_score=DBL, rating=STR, last_verified=DATE)
SECTOR_ARTICLE = _struct(
    sector_article_id=STR,
    sector_id=INT,
    title=STR,
    content=STR,
    date_published=DATE,
    source_url=STR,
    author=STR,
    source_id=STR,
    impact_score=DBL,
    created_at=TS,
)
# Stored articles are partitioned by the month of publication, which reports filter by.
PUBLISHED_MONTH = "published_month"
TICKER_ARTICLE = _struct(
    ticker_article_id=STR,
    ticker_id=STR,
    sentiment_from_yesterday=BOOL,
    price_change_in_percentage=DBL,
    match=BOOL,
    created_at=TS,
    wordcloud_json=STR,
)

# Constraints of the warehouse: unique keys, required columns, foreign keys.
UNIQUE_KEYS = {
    "sectors": [["sector_id"], ["sector_name"]],
    "tickers": [["ticker_id"]],
    "sources": [["source_id"]],
    "sector_article": [["sector_article_id"], ["source_url"]],
    "ticker_article": [["ticker_article_id"]],
}
REQUIRED_COLUMNS = {
    "sectors": ["sector_id", "sector_name"],
    "tickers": ["ticker_id"],
    "sources": ["source_id"],
    "sector_article": ["sector_article_id"],
    "ticker_article": ["ticker_article_id"],
}
FOREIGN_KEYS = [
    ("tickers", "sector_id", "sectors", "sector_id"),
    ("sector_article", "sector_id", "sectors", "sector_id"),
    ("sector_article", "source_id", "sources", "source_id"),
    ("ticker_article", "ticker_id", "tickers", "ticker_id"),
]
