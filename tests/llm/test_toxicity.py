import re

import numpy as np
import pyarrow as pa

from tapewire.llm import toxicity as tox
from tapewire.llm.shingles import utf8


def names(texts):
    letters, starts, owner = tox.units(*utf8(pa.array(texts)))
    ends = [*starts[1:], len(letters)]
    word = lambda a, b: "".join("?^abcdefghijklmnopqrstuvwxyz####"[k] for k in letters[a:b])
    return [(int(o), word(a, b)) for a, b, o in zip(starts, ends, owner, strict=True)]


def test_units():
    assert names(["An id-iot", "", "you i d i o t", "1d10t", None, "été %%"]) == [
        (0, "^an"), (0, "^idiot"), (2, "^you"), (2, "^idiot"), (3, "^idiot"), (5, "^#t#"),
    ]


def test_sums_equal_a_plain_kernel():
    rng = np.random.default_rng(0)
    weights = rng.standard_normal(tox.LETTERS**4).astype(np.float32)
    letters, starts, _ = tox.units(*utf8(pa.array(["hello wonderful you", "ab abcdefgh"])))
    found = tox._sums(letters, starts, weights)
    for value, a, b in zip(found, starts, [*starts[1:], len(letters)], strict=True):
        unit, total, norm = letters[a:b].astype(int), 0.0, 0.0
        for i in range(len(unit)):
            for last in range(i + 3, min(i + tox.SPAN, len(unit))):
                for j in range(i + 1, last):
                    for k in range(j + 1, last):
                        code = (unit[i] << 15) | (unit[j] << 10) | (unit[k] << 5) | unit[last]
                        total += weights[code] * tox.DECAY ** (last - i + 1)
                        norm += tox.DECAY ** (2 * (last - i + 1))
        assert np.isclose(value, total / np.sqrt(max(norm, tox.DECAY**8)), atol=1e-4)


def test_gapped_insults_are_found():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(["the", "an", "er", "in", "sh", "on", "re"], 3))
    clean = [" ".join(word() for _ in range(40)) for _ in range(200)]
    toxic = [" ".join([*(word() for _ in range(30)), w, *(word() for _ in range(9))])
             for w in ["idiot", "moron", "trash", "clown"] * 40]
    machine = tox.train(clean + toxic, [0] * len(clean) + [1] * len(toxic))
    score = lambda *texts: machine.scores(*utf8(pa.array(texts)))
    assert (score("you id-iot", "an i d i o t on", "shin c.l.o.w.n er", "m0ron") > 0.5).all()
    assert (score("", "shinon reer", "in the an") < 0.5).all()


def test_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = tox.toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.04 * len(clean)


def test_held_out_insults_with_a_letter_put_in(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    learn = "crc32(cast(doc_id as string)) % 5 != 0"
    machine = tox.train(*tox.labelled_sample(docs.where(learn), labels.where(learn)))
    rest = docs.join(labels, "doc_id").where(f"not ({learn}) and text is not null").orderBy("doc_id")
    rng = np.random.default_rng(7)
    insults = "trash|pathetic|worthless|disgusting|idiot|loser|scum|moron|clown|stupid"

    def bent(found):
        k, letter = int(rng.integers(1, len(found[0]))), chr(97 + int(rng.integers(26)))
        return found[0][:k] + letter + found[0][k:]

    texts = [r.text for r in rest.where("toxic = 1").collect()]
    changed = [re.sub(rf"\b({insults})\b", bent, x, flags=re.I) for x in texts]
    changed = [b for a, b in zip(texts, changed, strict=True) if a != b]
    assert len(changed) >= 50
    assert (machine.scores(*utf8(pa.array(changed))) >= 0.5).mean() >= 0.85


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(4, 0, 1), (4, 0, 1), (6, 1, 0), (77, 1, 1), (None, 1, 1), (5, 1, None), (1, 1, 5)],
        "doc_id long, quality int, toxic int",
    )
    for marks in (labels, labels.where("toxic = 0"), labels.limit(0)):
        rows = tox.toxicity(odd_docs, marks).collect()
        assert len(rows) == odd_docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert tox.toxicity(no_docs, labels).collect() == []
