import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

from tapewire.llm import token_files as tf

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD = [
    "", "a", " a", "a ", "a\n", "\na", "a  b", "a \nb", "a\n b", "a\n  b", "a\n\n\nb", "x\tb",
    "don't we'll", "<|endoftext|> q", "foo...!!! bar***, baz%%%", "\x1cab !\x1c", "a\r\nb",
    "é È œuvre ½ 2² a1b2", "日本語 テキスト", "'s 're", "!'s x'", " a   b", "×a ÷,b é.É",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    texts = ODD + [a + b for a in ODD for b in ODD] + [None]
    ids, sizes = tf.Encoder(PATH).encode(pa.array(texts, pa.string()), 0)
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    for text, found in zip(texts, parts, strict=True):
        assert found.tolist() == plain(tokenizer, text), repr(text)


def test_names_of_tokens_inside_texts():
    """By default the tokenizer takes a token's name for the token, wherever it stands."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    name = "<|endoftext|>"
    texts = ODD + [a + name + b for a in ODD for b in ODD] + [name * 2, f"{name} {name}", f"x{name}"]
    encoder = tf.Encoder(PATH, named=True)
    assert encoder.by_piece
    ids, sizes = encoder.encode(pa.array(texts, pa.string()), 0)
    for text, found in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert found.tolist() == whole.encode(text, add_special_tokens=False).ids + [0], repr(text)
    assert 50256 in ids


def test_query_takes_names_for_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    from tapewire.llm.registry import QUERIES

    texts = ["x <|endoftext|> q", None, "", "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op1_token_files"](spark, str(tmp_path)).orderBy("doc_id")
    whole = Tokenizer.from_file(PATH)
    ids = [whole.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    sums = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [(r.n_tokens, r.ids_crc32) for r in found.collect()] == [
        (len(x), c) for x, c in zip(ids, sums, strict=True)
    ]


def test_lookup_reads_what_may_hold_the_ids(spark, tmp_path):
    """Rows that leave the scan: row groups of the ids sought, none for an absent id."""
    rows = spark.range(0, 40_000, 2).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    path = str(tmp_path / "orc")
    tf.write_tokens(rows.repartition(4), PATH, path)

    def read(ids):
        found = tf.lookup(spark, path, ids)
        got = sorted(r.doc_id for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [IsNotNull" in plan
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        return got, leaves.head().metrics().apply("numOutputRows").value()

    got, scanned = read([4, 39_000])
    assert got == [4, 39_000] and scanned <= 4 * tf.INDEX_ROWS
    got, scanned = read([20_001])
    assert got == [] and scanned <= tf.INDEX_ROWS


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 3)
    encoder = tf.Encoder(PATH)
    for text in ODD * 2:
        assert encoder.encode(pa.array([text]), 0)[0].tolist() == plain(tokenizer, text)


def test_other_vocabularies_encode_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    ids, sizes = tf.Encoder(path).encode(pa.array(["Some words, here", None]), 7)
    assert ids.tolist() == whole.encode("Some words, here", add_special_tokens=False).ids + [7, 7]
    assert sizes.tolist() == [len(ids) - 1, 1]


def expected(tokenizer, rows):
    out, start = [], 0
    for i, text in rows:
        ids = plain(tokenizer, text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, tokenizer, tmp_path, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    path = str(tmp_path / "orc")
    # Several files, although there is little to write.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tf.write_tokens(docs.repartition(5), PATH, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    found = tf.token_index(spark, path).orderBy("doc_id").collect()
    assert list(map(tuple, found)) == expected(tokenizer, rows)
    # Files hold ascending ranges, rows ascend in each, and a search reads what it may need.
    last = -1
    files = sorted((tmp_path / "orc").glob("part-*.orc"))
    assert len(files) > 1
    for file in files:
        table = orc.ORCFile(file).read(columns=["doc_id", "ids"])
        ids = table["doc_id"].to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        assert str(table["ids"].type) == "list<item: int32>" or table["ids"].type.value_type == "int32"
    hit = tf.read_tokens(spark, path).where(F.col("doc_id") == 17)
    assert [len(r.ids) for r in hit.collect()] == [len(plain(tokenizer, rows[17][1]))]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in (
        hit._jdf.queryExecution().toString()
    )


def test_odd_rows(spark, tokenizer, tmp_path, odd_docs, no_docs):
    tf.write_tokens(odd_docs, PATH, str(tmp_path / "odd"))
    found = tf.token_index(spark, str(tmp_path / "odd")).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0))
    sums = lambda t: sorted((-1 if r[0] is None else r[0], *r[2:]) for r in t)
    assert sums(found) == sums(expected(tokenizer, rows))
    ends = [r.start + r.n_tokens for r in found]
    assert [r.start for r in found] == [0, *ends[:-1]]
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    tf.write_tokens(no_docs, PATH, str(tmp_path / "none"))
    assert tf.token_index(spark, str(tmp_path / "none")).collect() == []
