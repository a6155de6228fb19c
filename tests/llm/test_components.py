import random

import pytest

from marketbars.llm.components import components


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1)], [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 80)] + [(-5, 79)], [(3, -3), (-3, 7), (8, 9)]])
def test_shapes(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    assert dict(map(tuple, components(df).collect())) == brute(edges)


def test_random_graph(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    df = spark.createDataFrame(edges, "u long, v long")
    assert dict(map(tuple, components(df).collect())) == brute(edges)
