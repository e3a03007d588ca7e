import random
import re

import pytest

from tapewire.llm import near_duplicates as nd


def plain(rows, percent=75):
    """(id, size, component, kept) of each row, from all pairs of sets."""
    found = []
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = max(len(words) - 4, 1) if words else 0
        found.append((i, {tuple(words[k : k + 5]) for k in range(n)}))
    root = {i: i for i, _ in found}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(found):
        for j, b in found[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return sorted((i, len(a), top(i), top(i) == i) for i, a in found)


def made(groups, seed):
    """Texts of the sizes of ``groups`` that differ from the group's first in some words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = []
    for size, changed in groups:
        base = [word() for _ in range(60)]
        for _ in range(size):
            text = base.copy()
            for _ in range(rng.randint(0, changed)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [512, 8])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = made([(40, 3), (30, 1), (25, 5), (2, 0), (1, 0), (60, 9)], seed=block)
    out = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == plain(rows)


def test_shuffled_texts_are_fetched_by_join(spark, monkeypatch):
    monkeypatch.setattr(nd, "BROADCAST_IDS", 0)
    rows = made([(12, 2), (8, 4)], seed=3)
    out = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == plain(rows)


def test_odd_rows(odd_docs):
    out = nd.near_duplicates(odd_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted(map(tuple, out.collect()), key=str)
    by_id = {}
    for row in found:
        by_id.setdefault(row[0], []).append(row[1:])
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[4] == [(1, 4, True)]
    assert sorted(by_id[5]) == [(1, 4, False), (2, 4, False)]
    assert by_id[6][0][1:] == (6, True) and by_id[7][0][1:] == (6, False)
    assert by_id[9] == [(1, 4, False)] * 2
    assert sorted(by_id[None]) == [(0, None, True), (1, None, True)]


def test_no_rows(no_docs):
    assert nd.near_duplicates(no_docs).collect() == []


def test_case_and_threshold(spark):
    words = [f"w{i}" for i in range(11)]
    # Sets of 7 shingles: 6 shared of 8 is 75 %, and 5 of 9 is not.
    rows = [(0, " ".join(words)), (1, " ".join(["x", *words[1:]])), (2, "X " + "\n".join(words[1:])),
            (3, " ".join(["y", "z", *words[2:]])), (4, "Ä b c d e f"), (5, "ä b c d e f")]
    out = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == plain(rows)
    assert plain(rows)[1][2] == 0 and plain(rows)[3][2] == 3 and plain(rows)[5][2] == 5
