import hashlib
import random
import re

import pytest

from tapewire.llm import decontamination as dc


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items):
    windows = {}
    for i, text in items:
        found = words(text)
        for k in range(max(len(found) - 9, 1) if found else 0):
            windows.setdefault(tuple(found[k : k + 10]), set()).add(str(i))
    out = []
    for i, text in docs:
        found, hit, ids = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(found) - n + 1):
                if owners := windows.get(tuple(found[k : k + n])):
                    ids |= owners
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(found), len(hit), len(ids), digest, bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("size", [dc.AUTOMATON_BYTES, 300])
def test_equals_a_plain_search(spark, monkeypatch, size):
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", size)
    rng = random.Random(size)
    word = lambda: "".join(rng.choices(["a", "b", "é", "Z", "9"], k=rng.randint(1, 2)))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 5, 10, 11, 30])))) for i in range(30)]
    items += [(3, items[3][1]), (31, items[0][1]), (32, ""), (33, None), (34, "!?")]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            found = words(rng.choice(items)[1])
            at, k = rng.randint(0, len(parts)), rng.randint(0, max(len(found) - 10, 0))
            parts[at:at] = found[k : k + rng.randint(9, 14)]
        docs.append((i, rng.choice([" ", ", ", "--\n"]).join(parts)))
    found = dc.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        "doc_id",
    )
    assert sorted(map(tuple, dc.digest(found).collect())) == plain(docs, items)


def test_spans_lie_in_the_original_text(spark):
    text = "Ünder—«ONE  two», three four Five six seven eight nine; TEN eleven"
    docs = spark.createDataFrame([(1, text), (2, "x"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame(
        [(7, "one two three four five six seven eight nine ten"), (8, "x")], "item_id long, text string"
    )
    rows = dc.with_spans(dc.contamination(docs, items, "doc_id")).orderBy("doc_id").collect()
    assert [text[s.start : s.end] for s in rows[0].spans] == []
    text = text.replace("—«", " (").replace("»", ")")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = dc.with_spans(dc.contamination(docs, items, "doc_id")).first()
    assert [text[s.start : s.end] for s in row.spans] == [text[text.index("ONE") : text.index(" eleven")]]
    assert [(s.start, s.end) for s in rows[1].spans] == [(0, 1)] and rows[2].spans == []


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, "two three", 0), (None, "4711", 0), (2, None, 0)], "item_id long, text string, runs int"
    )
    found = dc.contamination(odd_docs, items, "doc_id", "n_chars", "lang_pred")
    rows = {(r.doc_id, r.text): r for r in found.collect()}
    assert rows[4, "one two three"].n_words == 3
    assert [tuple(r) for r in rows[4, "one two three"].runs] == [(1, 2)]
    assert rows[8, "4711 * % 12"]["items"] == [""]
    assert rows[1, None].n_words == 0 and rows[2, ""].runs == []
    assert found.count() == odd_docs.count()
    assert dc.digest(dc.contamination(odd_docs, items.limit(0), "doc_id")).where("contaminated").isEmpty()
    assert dc.digest(dc.contamination(no_docs, items, "doc_id")).collect() == []
