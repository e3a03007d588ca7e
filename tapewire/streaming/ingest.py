"""Incremental loads of newly landed sector news.

``load_new_sector_articles`` does the same cleaning and merge as the daily run; Structured
Streaming only keeps track of which files were loaded, in place of a run date passed from
outside. ``load_first_arrivals`` drops repeated addresses by state with a watermark instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewire import schemas
from tapewire.functions import dates
from tapewire.operators.columns import align
from tapewire.operators.news import clean_sector_news, complete_articles, publish_window
from tapewire.operators.scoring import Scorer
from tapewire.plans.sector_articles import article_table, as_sector_articles, score_articles
from tapewire.session import checkpoint_root

# How long after the newest article copies of an older one are expected.
DELAY = "2 days"


def landed_sector_news(spark: SparkSession, landing: str, files_a_batch: int | None = None) -> DataFrame:
    """Landed sector news as a stream, with the run date from the path."""
    reader = spark.readStream.schema(schemas.RAW_SECTOR_NEWS).option("recursiveFileLookup", "true")
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"date=(\d{4}-\d{2}-\d{2})", 1)
    return reader.json(landing).select("*", run.try_cast("date").alias("run_date"))


def first_arrivals(news: DataFrame, delay: str = DELAY) -> DataFrame:
    """A stream's complete articles inside the news window of their run, each address once.

    An address is kept in the state until the watermark, ``delay`` behind the newest publish
    instant, has passed the article by the same delay. Copies until then are dropped, and what
    is published before the watermark is late and dropped as well (``late_rows``). Which of
    several copies in one batch stays is open. An article without an instant counts from the
    start of its run date.
    """
    rows = complete_articles(publish_window(news, "run_date"))
    rows = rows.withColumns(
        {
            "source_url": F.trim("source_url"),
            "_published": dates.publish_instant("date_published", "run_date"),
        }
    )
    once = rows.withWatermark("_published", delay).dropDuplicatesWithinWatermark(["source_url"])
    dated = once.withColumn("date_published", dates.calendar_date("date_published"))
    return align(dated, schemas.SECTOR_CLEAN, ["run_date"])


def load_first_arrivals(
    spark: SparkSession,
    landing: str,
    table: str,
    name: str,
    delay: str = DELAY,
    files_a_batch: int | None = None,
) -> StreamingQuery:
    """Append what has landed since the last call of this name to ``table``, then stop.

    Needs no look at the stored rows: the state tells which addresses came before. State and
    progress lie under ``spark.checkpoint.dir``.
    """
    stream = first_arrivals(landed_sector_news(spark, landing, files_a_batch), delay)
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{checkpoint_root(spark)}/{name}")
        .trigger(availableNow=True)
        .start(table)
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the batches of a query (the last hundred) dropped for being late."""
    return sum(
        int(state["numRowsDroppedByWatermark"])
        for batch in query.recentProgress
        for state in batch["stateOperators"]
    )


def load_new_sector_articles(
    spark: SparkSession,
    landing: str,
    table: str,
    scorer: Scorer,
    name: str,
) -> StreamingQuery:
    """Load what has landed since the last call of this name, then stop.

    A batch that is replayed after a failure inserts nothing twice, since the merge skips
    the addresses that are already there.
    """
    article_table(spark, table)
    landed = landed_sector_news(spark, landing)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        clean = clean_sector_news(batch, "run_date", first_run_wins=True)
        # Stored addresses go before anything is scored.
        stored = article_table(batch.sparkSession, table)
        fresh = stored.new_rows(clean, [F.col("run_date").asc()])
        stored.append(as_sector_articles(score_articles(fresh, scorer, "run_date"), "run_date"))

    root = checkpoint_root(spark)
    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{root}/{name}")
        .trigger(availableNow=True)
        .start()
    )
