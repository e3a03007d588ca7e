import random

import pytest

from tapewire.llm.components import components
from tapewire.llm.store import Scratch


def plain(edges):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((top(u), top(v)))
        root[b] = a
    return {x: top(x) for x in root if top(x) != x}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1)],
        [(i + 1, i) for i in range(24)],
        [(i, 0) for i in range(1, 50)] + [(99, i) for i in range(60, 90)] + [(99, 40)],
        [(random.Random(i).randrange(200), random.Random(-i).randrange(200)) for i in range(1, 150)],
    ],
)
def test_components(spark, edges):
    table = spark.createDataFrame(edges + edges[:5], "u long, v long")
    out = components(table, Scratch(spark, "test"))
    assert dict(map(tuple, out.collect())) == plain(edges)
