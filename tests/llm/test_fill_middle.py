import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tapewire.llm import fill_middle as fim


def plain(doc_id, text, seed=7, rate=100, spm=50):
    """(n, form, prefix_chars, middle_chars, output), by joining the lines themselves."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 63, 64, 65, 513, 4097])
def test_every_rank_is_found(n):
    rng = random.Random(n)
    sizes = [rng.randint(1, 90) for _ in range(n)]
    units = fim.SkipList(sizes)
    assert units.units == n
    total = 0
    for rank, size in enumerate([*sizes, 0]):
        assert units.place(rank) == total
        total += size
    # Lanes thin out until one is short.
    assert len(units.lanes[-1]) <= fim.FAN and all(
        sum(w for w, _ in lane) == n and sum(c for _, c in lane) == sum(sizes)
        for lane in units.lanes
    )


@pytest.mark.parametrize("text", ["", "a", "\n", "\n\n", "a\n", "a\nb", "\r\n x\n\x85é𝄞", "𝄞\n𝄞𝄞"])
def test_lines(text):
    assert fim.lines(text) == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def test_outputs_equal_a_plain_version(spark):
    texts = [None, "", "one", "a\nb\nc", "x <P> y\nz", "<<S\nS>\n<", "<P\nM>\n<\nS", "\n\n\n", "é\n𝄞𝄞\nß"]
    rows = [(i * 10 + k, t) for i in range(20) for k, t in enumerate(texts)] + [(None, "a\nb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for seed, rate, spm in ((7, 100, 50), (3, 60, 20), (1, 0, 0), (1, 100, 100)):
        out = fim.fill_in_middle(docs, "doc_id", "text", seed=seed, rate=rate, spm=spm)
        found = out.withColumn("back", fim.restored()).collect()
        assert len(found) == len(rows)
        for r in found:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(
                r.doc_id, r.text, seed, rate, spm
            )
            assert r.back == (r.text or "")
    forms = {r.form for r in fim.fill_in_middle(docs).collect()}
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({"output": F.lit(1), "form": F.lit("x"), "_id": F.lit(2)})
    out = fim.fill_in_middle(clash, "doc_id", "text", "n_chars", "output", "form")
    assert out.columns == ["doc_id", "text", "n_chars", "n", "form", "prefix_chars",
                           "middle_chars", "output"]
    rows = out.withColumn("back", fim.restored()).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert fim.digest(fim.fill_in_middle(no_docs, "doc_id")).collect() == []


def test_long_text(spark):
    text = "".join(f"line {i} ü\n" for i in range(200_000)) + "end"
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    for r in fim.fill_in_middle(docs, "doc_id").collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, text)
