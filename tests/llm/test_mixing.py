import hashlib
import math

import pytest

from tapewire.llm import mixing
from tapewire.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(rows, target=None, limit=None, budget=1.0, block_tokens=mixing.BLOCK_TOKENS):
    """Drawn (doc_id, source, copy, block, place), and weights, without Spark."""
    docs = [(i, len((t or "").split()), s, md5(f"mix:{i}:{md5(t or '')}")) for i, t, s in rows]
    tokens = {}
    for _, n, s, _ in docs:
        tokens[s] = tokens.get(s, 0) + n
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}

    def weights(a):
        z = sum(x**a for x in share.values())
        return {s: x**a / z for s, x in share.items()}

    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    most = lambda a: max(w * budget / share[s] for s, w in weights(a).items())

    def bisect(low, holds):
        high = 1.0
        for _ in range(40):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(mid) else (low, mid)
        return low, high

    a = 1.0
    if target is not None and entropy(1.0) < target * math.log(len(share)):
        a = math.floor(bisect(0.0, lambda x: entropy(x) >= target * math.log(len(share)))[0] * 1e6)
        a /= 1e6
    if limit is not None and most(a) > limit:
        a = min(math.ceil(bisect(a, lambda x: most(x) > limit)[1] * 1e6) / 1e6, 1.0)
    found, drawn = weights(a), []
    for s in tokens:
        if s not in share:
            continue
        blocks = max(math.ceil(tokens[s] / block_tokens), 1)
        repeats = round(found[s] * budget / share[s], 9)
        for b in range(blocks):
            own = sorted((d for d in docs if d[2] == s and int(d[3][24:32], 16) % blocks == b),
                         key=lambda d: d[3])
            held, place = sum(d[1] for d in own), 0
            for i, n, _, _ in own:
                more = place + n / 2 < (repeats - math.floor(repeats)) * held
                drawn += [(i, s, c, b, place) for c in range(math.floor(repeats) + more)]
                place += n
    return sorted(drawn, key=str), found


def corpus():
    sizes = {"big": 300, "mid": 60, "small": 9, None: 20}
    rows = [(s, k) for s, n in sizes.items() for k in range(n)]
    return [(i, " ".join(["w"] * (1 + (i * 37) % 23)), s) for i, (s, _) in enumerate(rows)]


@pytest.mark.parametrize(
    ("target", "limit", "budget", "block_tokens"),
    [(None, None, 1.0, 10**6), (0.95, None, 1.0, 400), (0.95, 2.0, 1.0, 400), (1.0, 1.0, 0.5, 150)],
)
def test_equals_a_plain_version(spark, monkeypatch, target, limit, budget, block_tokens):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block_tokens)
    rows = corpus()
    want, weights = plain(rows, target, limit, budget, block_tokens)
    out = mix(spark.createDataFrame(rows, SCHEMA), target, limit, budget).collect()
    assert sorted(((r.doc_id, r.source, r.copy, r.block, r.place) for r in out), key=str) == want
    for row in out:
        assert math.isclose(row.weight, weights[row.source], abs_tol=1e-9)
    if limit:
        copies = {}
        for row in out:
            copies[row.doc_id] = copies.get(row.doc_id, 0) + 1
        assert max(copies.values()) <= math.ceil(limit)


def test_target_entropy_is_met(spark):
    rows = corpus()
    out = mix(spark.createDataFrame(rows, SCHEMA), target_entropy=0.97).collect()
    drawn = {}
    for row in out:
        drawn[row.source] = drawn.get(row.source, 0) + row.n_tokens
    total = sum(drawn.values())
    entropy = -sum(n / total * math.log(n / total) for n in drawn.values())
    assert entropy >= 0.95 * math.log(4)
    # The mixture is read by turn and place: whole blocks, one after another.
    turns = [r.turn for r in sorted(out, key=lambda r: (r.turn, r.place))]
    assert len({r.turn for r in out}) == len({(r.source, r.block, r.copy) for r in out})
    assert sum(a != b for a, b in zip(turns, turns[1:])) == len(set(turns)) - 1


def test_budget_beyond_the_limit(spark):
    with pytest.raises(ValueError, match="budget"):
        mix(spark.createDataFrame(corpus(), SCHEMA), max_repeats=1.0, budget_share=2.0)


def test_odd_rows(spark, odd_docs, no_docs):
    out = mix(odd_docs, target_entropy=0.9, max_repeats=3.0)
    assert {"n_chars", "lang_pred", "runs", "weight", "turn"} <= set(out.columns)
    assert {r.doc_id for r in out.collect()} >= {6, 7}
    assert mix(no_docs, target_entropy=0.9, max_repeats=3.0).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert mix(blank, 0.9, 3.0).collect() == []
