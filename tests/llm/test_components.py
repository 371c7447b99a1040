import random

from servicerank.llm.components import components


def test_components_of_random_links_and_long_chains(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(90)]
    links += [(5000, i) for i in range(2000, 2200)] + [(7, 7), (None, 3)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {i: root(i) for i in list(parent)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
