"""Classes of random graphs, chains, stars, repeated and empty links."""

import random

from daystrata.llm import links


def test_classes(spark):
    random.seed(3)
    edges = [(random.randrange(120), random.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 240)]
    edges += [(300, k) for k in range(301, 330)] + [(301, 300), (7, 7), (None, 4), (5, None)]
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and root(a) != root(b):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    found = [tuple(r) for r in links.classes(spark.createDataFrame(edges, "a bigint, b bigint")).collect()]
    assert sorted(found) == sorted((x, root(x)) for x in linked)
    assert links.classes(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
