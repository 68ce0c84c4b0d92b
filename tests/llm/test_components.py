import random

from tessera.llm.components import components


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {(x, root(x)) for x in list(parent) if root(x) != x}


def check(spark, edges):
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(edges)


def test_chain_star_cycle_and_repeats(spark):
    chain = [(i, i + 1) for i in range(60)]
    random.Random(1).shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000) for i in range(-50, 0)]
    check(spark, chain + star + [(5000, 5001), (5001, 5002), (5002, 5000), (5001, 5000), (7, 7), (8000, 8000)])


def test_random_graph(spark):
    rng = random.Random(2)
    check(spark, [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)])


def test_no_links(spark):
    check(spark, [])
    check(spark, [(1, 1)])
