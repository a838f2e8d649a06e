"""Components against union-find on chains, stars and random graphs."""

from __future__ import annotations

import random

import pytest

from gridloom.llm.common import connected_components


def expected(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(random.Random(3).randrange(90), random.Random(i).randrange(90)) for i in range(70)], [(5, 2), (2, 5), (2, 9)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == expected(edges)
