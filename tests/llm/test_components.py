"""Connected components on chains, hubs and random links."""

import random

from retally.llm.components import components


def slow(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return sorted((n, find(n)) for n in root)


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    hub = [(5, 2000 + i) for i in range(200)] + [(2000 + i, 5) for i in range(50)]
    loose = [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(90)]
    links = [(a, b) for a, b in chain + hub + loose if a != b]
    got = sorted(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == slow(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
