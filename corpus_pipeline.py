"""From raw documents to token files, in five stages that each write a table.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the
columns of ``documents``; the last returns the index of the token files that it wrote.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapewire.llm.decontamination import contamination
from tapewire.llm.language import UNDETERMINED, identify, learned_pieces
from tapewire.llm.mixing import mix
from tapewire.llm.near_duplicates import near_duplicates
from tapewire.llm.store import Scratch
from tapewire.llm.token_files import token_index, write_tokens

TOKENIZER = "byte_bpe_50k.json"
# Mixture: least entropy as a share of the greatest, and tokens to draw per token there is where
# the documents have less.
TARGET_ENTROPY, BUDGET_SHARE = 0.98, 0.8

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keeps_columns(stage):
    """The stage on columns of which only the known ones keep their names meanwhile.

    So a further column may have any name, also one that an operator adds.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"_further{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        kept = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return kept.withColumnsRenamed({new: old for old, new in names.items()})

    return run


@keeps_columns
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those that two languages fit equally well."""
    found = identify(docs, learned_pieces(docs), *docs.columns)
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0)).select(
        *docs.columns
    )


@keeps_columns
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, and one row of each document.

    Rows without an id stay.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    named = docs.join(kept, "doc_id", "left_semi").withColumn("_row", F.row_number().over(first))
    named = named.where("_row = 1").select(*docs.columns)
    return named.union(docs.where("doc_id is null"))


@keeps_columns
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keep = [c for c in docs.columns if c != "text"]
    return contamination(docs, benchmark, *keep).where(F.size("runs") == 0).select(*docs.columns)


@keeps_columns
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents towards even sources, none of them twice.

    All of them where sources are even enough already, else BUDGET_SHARE of the tokens.
    """
    drawn = mix(
        docs, TARGET_ENTROPY, max_repeats=1.0, budget_share=BUDGET_SHARE, whole_if_even=True
    )
    return drawn.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns the index read from them."""
    from public_tokenizers import path

    files = Scratch(spark, "pipeline-tokens").path("orc")
    write_tokens(docs, path(TOKENIZER), files, named=True)
    return token_index(spark, files)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mixture),
    ("token-ID output", tokens),
]

# Cross-parsing, hashed permutations of binary sketches and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each from the table that the one before wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
