import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tapewire.llm import lm_scoring as lm
from tapewire.llm import recurrent as rnn


def words(text):
    return [*bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split(), lm.END]


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def plain_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) by counting."""
    counts = Counter(w for i, text in rows if learned(i) for w in words(text))
    n, v = sum(counts.values()), len(counts)
    return [
        (i, not learned(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)))
        for i, t in rows
    ]


def plain_score(text, vocabulary, params):
    """The log10 probability of one text, step by step and word by word."""
    p = {k: v.astype(np.float64) for k, v in rnn.unpacked(params, vocabulary.layout).items()}
    gate = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    size, ranked = rnn.HIDDEN, len(vocabulary.words)
    h, before, total = np.zeros(size), vocabulary.end(), 0.0
    for token, share in text:
        x, a = p["x"][before], h @ p["u"]
        r, z = gate(x[:size] + a[:size]), gate(x[size : 2 * size] + a[size : 2 * size])
        c = np.tanh(x[2 * size :] + r * a[2 * size :])
        h = (1 - z) * c + z * h
        classes = softmax(h @ p["class_w"] + p["class_b"])
        if token < ranked:
            k = token // rnn.WIDTH
            inner = softmax(h @ p["word_w"][k] + p["word_b"][k])
            total += math.log10(classes[k]) + math.log10(inner[token % rnn.WIDTH])
        else:
            total += math.log10(classes[vocabulary.layout.shared + token - ranked]) + share
        before = token
    return total


def encoded(rows, vocabulary):
    """Each text's (token, log10 share), from the words themselves."""
    counts = Counter(w for i, text in rows if learned(i) for w in words(text))
    rank = {w: k for k, (w, _) in enumerate(vocabulary.words)}
    bands = {}
    for w, n in counts.items():
        if w not in rank:
            bands.setdefault(n.bit_length() - 1, []).append(n)
    bands.setdefault(0, [])
    names = sorted(bands)

    def of(w):
        if w in rank:
            return rank[w], 0.0
        n = counts[w]
        band = max(n.bit_length() - 1, 0)
        own = bands[band]
        share = 1 / (len(own) + 1) if band == 0 else n / sum(own)
        return len(rank) + names.index(band), math.log10(share)

    return [[of(w) for w in words(text)] for _, text in rows]


@pytest.fixture
def recorded(monkeypatch):
    held = {}
    real = lm.train

    def train(rows, vocabulary, scratch):
        held["vocabulary"], held["params"] = vocabulary, real(rows, vocabulary, scratch)
        return held["params"]

    monkeypatch.setattr(lm, "train", train)
    return held


@pytest.mark.parametrize(("block", "shard"), [(lm.BLOCK, lm.SHARD), (20_000, 10_000)])
def test_equals_a_plain_version(spark, small, recorded, monkeypatch, block, shard):
    monkeypatch.setattr(lm, "BLOCK", block)
    monkeypatch.setattr(lm, "SHARD", shard)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = lm.lm_scores(docs, "doc_id")
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"]
    rows = {r.doc_id: r for r in out.collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == len(texts)
    for *exact, base in plain_base(texts):
        row = tuple(rows[exact[0]])
        assert list(row[:5]) == exact and math.isclose(row[5], base, rel_tol=1e-9)
    vocabulary = recorded["vocabulary"]
    some = sorted(texts, key=lambda r: len(r[1]))[::9]
    every = dict(zip([i for i, _ in texts], encoded(texts, vocabulary), strict=True))
    for i, _ in some:
        want = plain_score(every[i], vocabulary, recorded["params"])
        assert math.isclose(rows[i].score, want, rel_tol=1e-4)
    for held_out in (True, False):
        own = [r for r in rows.values() if r.held_out == held_out]
        assert sum(r.score for r in own) > sum(r.base_score for r in own)


def test_order_matters_to_the_model(spark, medium):
    """Held-out texts are likelier than under counts alone, and than with their words shuffled."""
    import random

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{medium}/documents.parquet").collect()]
    held = [(i, t) for i, t in docs if not learned(i)]
    mixed = []
    for i, text in held:
        # New ids that are held out as well.
        new = next(k for k in range(10_000 * (i + 1), 10_000 * (i + 2)) if not learned(k))
        parts = text.split()
        random.Random(i).shuffle(parts)
        mixed.append((new, " ".join(parts)))
    table = spark.createDataFrame(docs + mixed, "doc_id long, text string")
    rows = {r.doc_id: r for r in lm.lm_scores(table, "doc_id").collect()}
    better = sum(rows[i].score > rows[i].base_score for i, _ in held)
    assert better >= 0.95 * len(held)
    total = lambda some: sum(rows[i].score for i, _ in some)
    assert total(held) > total(mixed)


def test_probabilities_add_up_to_one():
    words = [(str(k).encode(), 50 - k) for k in range(40)]
    vocabulary = lm.Vocabulary(words, [(0, 7, 7), (3, 2, 20)], 900, 49)
    layout = vocabulary.layout
    model = rnn.Model(layout, rnn.initial(layout, vocabulary.counts()))
    random = np.random.default_rng(0)
    h = np.repeat(random.standard_normal((rnn.HIDDEN, 3)).astype(np.float32), layout.tokens, 1)
    found, _ = model.log_probs(h, np.tile(np.arange(layout.tokens), 3))
    assert np.allclose(np.exp(found).reshape(3, -1).sum(axis=1), 1, atol=1e-5)
    # Shares within bands: the lowest has one word more, which no training text holds.
    n = np.array([1, 0, 8, 12])
    token, share, _ = vocabulary.encode(np.full(4, -1), n)
    assert token.tolist() == [40, 40, 41, 41]
    assert np.allclose(10**share, [1 / 8, 1 / 8, 8 / 20, 12 / 20])


def test_gradients_equal_differences(monkeypatch):
    layout = rnn.Layout(40, 3)
    random = np.random.default_rng(1)
    params = {k: random.standard_normal(s) * 0.5 for k, s in rnn.shapes(layout).items()}
    model = rnn.Model(layout, params)
    shape = (5, 4)
    before, target = random.integers(0, 43, shape), random.integers(0, 43, shape)
    fresh = random.random(shape) < 0.3
    h = random.standard_normal((rnn.HIDDEN, 4))
    monkeypatch.setattr(np, "float32", np.float64)
    _, grad, _ = model.window(h, before, target, fresh)
    for name, values in params.items():
        flat = values.reshape(-1)
        for at in random.choice(flat.size, min(12, flat.size), replace=False):
            step, old = 1e-5, flat[at]
            flat[at] = old + step
            up = model.window(h, before, target, fresh)[0]
            flat[at] = old - step
            down = model.window(h, before, target, fresh)[0]
            flat[at] = old
            assert np.isclose(-(up - down) / (2 * step), grad[name].reshape(-1)[at], atol=1e-4)


def test_states_cross_windows():
    """A text whose next word depends on one far before it, beyond a window of scoring."""
    layout = rnn.Layout(8, 1)
    model = rnn.Model(layout, rnn.initial(layout, np.ones(9)))
    texts = [np.array([k % 2, *[2] * 80, k % 2, 7], np.int32) for k in range(6)]
    texts += [np.array([7], np.int32)]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = model.scores(np.concatenate(texts), at, 7)
    for text, score in zip(texts, together, strict=True):
        h, total, before = np.zeros((rnn.HIDDEN, 1), np.float32), 0.0, 7
        for token in text:
            h, _ = model.step(h, model.params["x"][[before]].T)
            total += float(model.log_probs(h, np.array([token]))[0][0])
            before = token
        assert math.isclose(score, total, rel_tol=1e-5)
    assert not math.isclose(together[0], together[1], rel_tol=1e-6)


def test_scoring_fills_its_windows(monkeypatch):
    """Few long texts go through the output many tokens at a time, at the scores of one text
    in one small window after another."""
    layout = rnn.Layout(8, 1)
    model = rnn.Model(layout, rnn.initial(layout, np.ones(9)))
    random = np.random.default_rng(3)
    sizes = [3000, 1, 700, 40, 2999, 1]
    tokens = random.integers(0, 9, sum(sizes)).astype(np.int32)
    at = np.concatenate([[0], np.cumsum(sizes)])
    calls, real = [], model.log_probs
    monkeypatch.setattr(
        model, "log_probs", lambda h, target: calls.append(len(target)) or real(h, target)
    )
    found = model.scores(tokens, at, 7)
    assert calls == [len(tokens)]
    monkeypatch.setattr(rnn, "PLACES", 7)
    monkeypatch.setattr(rnn, "ROWS", 3)
    for a, b, score in zip(at[:-1], at[1:], found, strict=True):
        assert math.isclose(score, model.scores(tokens[a:b], np.array([0, b - a]), 7)[0], rel_tol=1e-5)
    assert np.allclose(model.scores(tokens, at, 7), found, rtol=1e-5)


def test_training_learns_an_order():
    layout = rnn.Layout(8, 1)
    model = rnn.Model(layout, rnn.initial(layout, np.ones(9)))
    text = [0, 1, 2, 3, 4, 5, 6, 7]
    tokens, first = np.array(text * 3000, np.int32), np.zeros(24_000, bool)
    first[::8] = True
    start = model.scores(np.array(text), np.array([0, 8]), 7)[0]
    model.train(tokens, first, 7, 0.02)
    assert model.scores(np.array(text), np.array([0, 8]), 7)[0] > start / 4


@pytest.mark.parametrize(
    "texts", [[""], ["a"], ["  a  b "], ["\tA\x0bb\n", "", " ", "é Ü\x85x"], [" "], ["", ""]]
)
def test_tokens(texts):
    found, at = lm._tokens(pa.array(texts))
    found = found.to_pylist()
    assert [found[a:b] for a, b in zip(at[:-1], at[1:])] == [words(t) for t in texts]


def test_odd_rows(spark, odd_docs, no_docs):
    out = lm.lm_scores(odd_docs, *odd_docs.columns)
    assert out.columns.count("n_tokens") == 1 and "n_chars" in out.columns
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    key = lambda r: (str(r[0]), r[2], r[-1])
    want = sorted(plain_base(texts), key=key)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    rows = sorted((tuple(r[:6]) for r in out.select(*names, "score").collect()), key=key)
    for row, wanted in zip(rows, want, strict=True):
        assert row[:5] == wanted[:5] and math.isclose(row[5], wanted[5], rel_tol=1e-9)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out.collect())
    assert lm.lm_scores(no_docs, "doc_id").collect() == []
    none = lm.lm_scores(odd_docs, "doc_id", learn="doc_id < 0").collect()
    assert len(none) == odd_docs.count()
    assert {(r.train_tokens, r.base_score, r.score, r.n_known) for r in none} == {(0, 0.0, 0.0, 0)}
