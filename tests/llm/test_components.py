import random

from kelpline.llm import components as c


def brute(edges):
    parent = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a in parent and b in parent and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return sorted((x, find(x)) for x in parent)


def got(spark, edges):
    found = c.components(spark.createDataFrame(edges, "a long, b long"))
    assert found.dtypes == [("node", "bigint"), ("root", "bigint")]
    return sorted(map(tuple, found.collect()))


def made():
    """A path in mixed order, a hub, pairs, the ends of long, loops and nulls."""
    rng = random.Random(4)
    path = rng.sample(range(-500, 500), 60)
    hub = [(2000, k) for k in range(1000, 1060)]
    pairs = [(rng.randrange(3000, 3080), rng.randrange(3000, 3080)) for _ in range(40)]
    return [*zip(path, path[1:]), *hub, *pairs, (2**63 - 1, -(2**63)), (7000, 7000), (None, 7001), (7002, None), (2000, 1000)]


def test_both_ways_give_the_same_rows(spark, monkeypatch):
    want = brute(made())
    assert got(spark, made()) == want
    monkeypatch.setattr(c, "SMALL", 0)
    assert got(spark, made()) == want


def test_no_edges(spark):
    assert got(spark, []) == got(spark, [(1, 1), (None, 2)]) == []


def test_few_edges_take_few_jobs(spark):
    """Each job of a shuffle leaves files of every task, however few rows it has."""
    sc = spark.sparkContext
    sc.setJobGroup("few edges", "")
    try:
        c.components(spark.createDataFrame(made(), "a long, b long"))
        assert len(sc.statusTracker().getJobIdsForGroup("few edges")) <= 8
    finally:
        sc._jsc.clearJobGroup()
