from __future__ import annotations

import random

import pytest

from tillwright.llm.components import components


def by_hand(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    linked = {x for u, v in edges if u != v for x in (u, v)}
    return sorted((x, root(x)) for x in linked)


RNG = random.Random(8)
GRAPHS = {
    "none": [],
    "loops": [(1, 1), (2, 2)],
    "path": [(i, i + 1) for i in range(60)],
    "path in odd order": [(a, b) for a, b in zip(RNG.sample(range(60), 60), RNG.sample(range(60), 60))],
    "star": [(500, i) for i in range(200)] + [(i, 500) for i in range(30)],
    "random": [(RNG.randrange(300), RNG.randrange(300)) for _ in range(180)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_are_those_by_hand(spark, name):
    edges = spark.createDataFrame(GRAPHS[name], "u long, v long")
    assert sorted(map(tuple, components(spark, edges).collect())) == by_hand(GRAPHS[name])
