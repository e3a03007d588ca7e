import pytest

import corpus_pipeline as pipeline
from tapewire.llm.store import Scratch

from tests.llm import test_decontamination, test_mixing, test_near_duplicates, test_token_files
from tests.llm.test_token_files import tokenizer  # noqa: F401

pytest.importorskip("public_tokenizers")


def test_stages_equal_plain_versions(spark, small, tokenizer):  # noqa: F811
    """Each stage's documents against plain Python, on the documents of the one before."""
    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in pipeline.STAGES:
        kept["in", name] = docs
        docs = kept[name] = scratch.save(stage(spark, docs, small), "stage")
    names = [name for name, _ in pipeline.STAGES]
    for name in names[:-1]:
        assert kept[name].columns == columns

    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    first, near, clean, mixed, last = names
    before = texts(kept["in", first])
    assert texts(kept[first]) == [r for r in before if any(c.isalpha() for c in r[1])]
    groups = test_near_duplicates.plain(texts(kept["in", near]))
    assert [i for i, _ in texts(kept[near])] == [i for i, _, _, keep in groups if keep]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    hit = {r[0] for r in test_decontamination.plain(texts(kept["in", clean]), items) if r[-1]}
    assert hit and texts(kept[clean]) == [r for r in texts(kept["in", clean]) if r[0] not in hit]
    rows = [(r.doc_id, r.text, r.source) for r in kept["in", mixed].collect()]
    want, _ = test_mixing.plain(rows, pipeline.TARGET_ENTROPY, 1.0, pipeline.BUDGET_SHARE)
    assert sorted(i for i, _ in texts(kept[mixed])) == sorted(r[0] for r in want)
    found = sorted(map(tuple, kept[last].collect()))
    assert found == test_token_files.expected(tokenizer, texts(kept["in", last]))


@pytest.mark.parametrize(
    ("sizes", "least", "most"),
    [((40, 44, 36), 1, 1), ((40,), 1, 1), ((900, 40, 30), 0.79, 0.81)],
)
def test_mixture_keeps_even_sources_whole(spark, small, sizes, least, most):
    rows = [(f"w{i} " * 50, s) for s, n in enumerate(sizes) for i in range(n)]
    docs = [(k, text, "en", str(s), 0) for k, (text, s) in enumerate(rows)]
    table = spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string, n_chars long"
    )
    drawn = [r.doc_id for r in pipeline.mixture(spark, table, small).collect()]
    assert len(set(drawn)) == len(drawn)
    assert least <= len(drawn) / len(docs) <= most


def test_odd_documents(spark, odd_docs, no_docs, small):
    for docs in (odd_docs, no_docs):
        columns, scratch = docs.columns, Scratch(spark, "test-pipeline")
        for _, stage in pipeline.STAGES[:-1]:
            docs = scratch.save(stage(spark, docs, small), "stage")
            assert docs.columns == columns
        assert pipeline.tokens(spark, docs, small).count() == docs.count()


def test_run(spark, small):
    out = pipeline.run(spark, small)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert 0 < out.count() < 200
