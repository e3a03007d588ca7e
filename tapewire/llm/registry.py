"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.llm import fill_middle, periodic_runs
from tapewire.llm.decontamination import contamination, digest
from tapewire.llm.embedding_duplicates import embedding_duplicates
from tapewire.llm.inputs import view
from tapewire.llm.language import language_id
from tapewire.llm.lm_scoring import lm_scores
from tapewire.llm.mixing import mix
from tapewire.llm.near_duplicates import near_duplicates
from tapewire.llm.oracle import ORACLE
from tapewire.llm.quotations import link_quotations
from tapewire.llm.store import Scratch
from tapewire.llm.token_files import token_index, write_tokens
from tapewire.llm.toxicity import toxicity
from tapewire.llm.url_lists import on_lists
from tapewire.llm.warc import derivatives, responses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["ORACLE", "QUERIES"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_minhash_near_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@query
def op3_embedding_near_dedup(spark, sf):
    return embedding_duplicates(table(spark, sf, "embeddings"))


@query
def op2_language_id(spark, sf):
    return language_id(table(spark, sf, "documents"))


@query
def op6_benchmark_decontamination(spark, sf):
    docs, benchmark = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return digest(contamination(docs, benchmark, "doc_id"))


@query
def op10_toxicity(spark, sf):
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op1_token_files(spark, sf):
    from public_tokenizers import path

    files = Scratch(spark, "token-files").path("orc")
    write_tokens(table(spark, sf, "documents"), path("byte_bpe_50k.json"), files, named=True)
    return token_index(spark, files)


@query
def op4_source_mixing(spark, sf):
    drawn = mix(
        table(spark, sf, "documents").select("doc_id", "text", "source"),
        target_entropy=0.98,
        max_repeats=4.0,
    )
    return drawn.select(
        "doc_id", "source", "copy", "block", "turn", "place", "n_tokens",
        F.round("weight", 9).alias("weight"),
    )


@query
def op5_warc_derivatives(spark, sf):
    pages = view(spark, sf, "captures").withColumnRenamed("fetched", "date")
    return derivatives(responses(pages))


@query
def op7_quotation_linking(spark, sf):
    return link_quotations(view(spark, sf, "mails"))


@query
def op8_temporal_url_lists(spark, sf):
    return on_lists(view(spark, sf, "captures"), view(spark, sf, "list_entries"))


@query
def op11_fill_in_middle(spark, sf):
    return fill_middle.digest(fill_middle.fill_in_middle(table(spark, sf, "documents"), "doc_id"))


@query
def op12_lm_scoring(spark, sf):
    return lm_scores(table(spark, sf, "documents"), "doc_id")


@query
def op13_periodic_runs(spark, sf):
    docs = periodic_runs.with_planted_periods(table(spark, sf, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, "doc_id"))
