import random

import numpy as np
import pyarrow as pa
import pytest

from tapewire.llm import language as lang
from tapewire.llm.shingles import utf8


def phrases(text: bytes, known: list[bytes]) -> int:
    """Longest phrases of ``text``, each of which lies within one known piece."""
    at = n = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and any(text[at : at + size + 1] in k for k in known):
            size += 1
        at, n = at + size, n + 1
    return n


def normal(text: str) -> bytes:
    return lang.plain(*utf8(pa.array([text])))[0].tobytes()


@pytest.mark.parametrize("seed", range(4))
def test_phrases_equal_a_plain_parse(seed):
    rng = random.Random(seed)
    word = lambda abc: "".join(rng.choices(abc, k=rng.randint(1, 6)))
    pieces = {k: [" ".join(word(abc) for _ in range(40)) for _ in range(3)]
              for k, abc in (("x", "abcé"), ("y", "bcdü"), ("z", "aeß"))}
    model = lang.Model(pieces)
    texts = [" ".join(word("abcdeéüßq") for _ in range(rng.randint(0, 60))) for _ in range(20)]
    texts = [t[:400] for t in texts] + [""]
    rates = model.rates(*lang.plain(*utf8(pa.array(texts))))
    for text, row in zip(texts, rates, strict=True):
        data = normal(text)
        for k, automaton, rate in zip(model.languages, model.automata, row, strict=True):
            n = phrases(data, [normal(p) for p in pieces[k]])
            assert np.isclose(rate, n * automaton.bits / max(len(data), 1))


def test_plain_text():
    assert normal("Ab--C1  ÉÜ×.") == "ab c éü× ".encode()


def test_long_texts_are_cut_into_stretches():
    model = lang.Model({"a": ["the cat sat on the mat " * 20], "b": ["zu und der die das " * 20]})
    rates = model.rates(*lang.plain(*utf8(pa.array(["the cat sat " * 5000, "und der " * 9000]))))
    assert rates.argmin(axis=1).tolist() == [0, 1]


def test_pieces_come_from_the_whole_text(spark):
    """A head that all texts share is in few pieces, and too many languages are an error."""
    head = "all rights reserved by the publisher " * 20
    rows = [("en", head + " ".join(f"word{i}x{k}" for k in range(2000))) for i in range(80)]
    table = spark.createDataFrame(rows, "lang string, text string")
    found = lang.sample_pieces(table)["en"]
    assert len(found) > 30 and all(len(p) == lang.PIECE_CHARS for p in found)
    assert sum("rights" in p for p in found) < 0.2 * len(found)
    many = spark.range(9).selectExpr("concat('l', id) as lang", "'some text' as text")
    with pytest.raises(ValueError, match="more than 8 languages"):
        lang.sample_pieces(many, languages=8)
    assert len(lang.sample_pieces(many, languages=9)) == 9


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    out = lang.language_id(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = lang.language_id(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for row, doc in zip(rows, odd_docs.collect(), strict=True):
        letters = any(c.isalpha() for c in doc.text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1 and (letters or row.score == 0)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert lang.language_id(no_docs).collect() == []
    unknown = lang.identify(odd_docs, {}, "doc_id").collect()
    assert {r.lang_pred for r in unknown} == {"und"}
