import numpy as np
import pytest

from tapewire.llm.embedding_duplicates import embedding_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.93):
    x = np.array([v for _, v, _ in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k for *_, k in rows])
    near = (x @ x.T >= least) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    ids = [i for i, *_ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(near[i]))]) for i in range(len(rows))]
    return sorted((ids[i], int(near[i].sum()), ids[root[i]], root[i] == i) for i in range(len(rows)))


def groups(seed, sizes, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        base, label = rng.standard_normal(16), int(rng.integers(0, 3))
        rows += [((base + spread * rng.standard_normal(16)).tolist(), label) for _ in range(size)]
    rows += rows[:7]
    return [(i, v, k) for i, (v, k) in enumerate(rows)]


@pytest.mark.parametrize("window", [512, 40])
def test_links_equal_all_pairs(spark, window):
    rows = groups(1, [30, 12, 5] + [1] * 60, 0.15)
    out = embedding_duplicates(spark.createDataFrame(rows, SCHEMA), window=window, passes=12)
    assert sorted(map(tuple, out.collect())) == plain(rows)


def test_narrow_windows_find_nine_links_of_ten(spark):
    rows = groups(2, [60, 40, 30] + [1] * 200, 0.2)
    out = embedding_duplicates(spark.createDataFrame(rows, SCHEMA), window=24, passes=12)
    found, true = (sum(r[1] for r in t) for t in (out.collect(), plain(rows)))
    assert 0.9 * true <= found <= true


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1),
        (5, [0.0, 0.0], 1), (6, [1.0, nan], 1), (7, [1.0, None], 1), (8, [inf, 0.0], 1),
        (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0], 1),
        (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [1e-30, 0.0], 1),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", rep string, rank int")
    out = sorted(map(tuple, embedding_duplicates(table).collect()), key=str)
    linked = {1: 4, 2: 4, 12: 4, 13: 4}
    want = [
        (i, linked.get(i, 0), (1 if i in linked else i), None if i is None else i == 1 or i not in linked)
        for i, *_ in rows
    ]
    want = [(i, n, c, True if i is None else k) for i, n, c, k in want]
    assert out == sorted(want, key=str)
    assert embedding_duplicates(table.limit(0)).collect() == []


def test_large_groups_and_labels_lose_no_link(spark):
    """A group and planted pairs in a label of many windows, and small labels beside it."""
    rng = np.random.default_rng(3)
    base, far = rng.standard_normal(16), rng.standard_normal((5000, 16))
    x = [base + 0.1 * rng.standard_normal((4500, 16)), far, far + 0.27 * rng.standard_normal(far.shape)]
    x = np.vstack([*x, rng.standard_normal((40, 16))]).astype(np.float32)
    label = np.array([0] * 14500 + [1 + i // 2 for i in range(40)])
    unit = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    want = near.sum(axis=1) - 1
    assert (want[:4500] > 3000).mean() > 0.9 and 1000 < (want[4500:9500] > 0).sum() < 5000
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    out = sorted(map(tuple, embedding_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert [n for _, n, *_ in out] == want.tolist()
    component = np.array([c for _, _, c, _ in out])
    i, j = np.nonzero(near)
    assert (component[i] == component[j]).all()


def test_windows_go_on_through_a_large_group(spark):
    """Groups of many windows: their links are found, and none of them counts twice."""
    rows = groups(4, [600, 150] + [1] * 150, 0.1)
    table = spark.createDataFrame(rows, SCHEMA)
    out = sorted(map(tuple, embedding_duplicates(table, window=48, passes=4).collect()))
    true = plain(rows)
    assert all(n <= m for (_, n, *_), (_, m, *_) in zip(out, true, strict=True))
    assert sum(r[1] for r in out) >= 0.99 * sum(r[1] for r in true)
    assert [r[2:] for r in out] == [r[2:] for r in true]


def test_exact_compares_all_pairs(spark):
    rows = groups(5, [60, 40, 30] + [1] * 200, 0.2)
    out = embedding_duplicates(spark.createDataFrame(rows, SCHEMA), exact=True, window=4)
    assert sorted(map(tuple, out.collect())) == plain(rows)
