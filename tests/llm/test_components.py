import random

import pytest

from seqloom.llm import components


def union_find(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {(root(x), x) for x in parent}


def graph(seed):
    rng = random.Random(seed)
    name = lambda i: f"S{i * 7919 % 1000:04d}"
    links = [(name(i), name(i + 1)) for i in range(90)]  # a chain
    links += [(name(200), name(200 + i)) for i in range(1, 120)]  # a star
    links += [(name(400 + rng.randint(0, 150)), name(400 + rng.randint(0, 150))) for _ in range(110)]
    links += [(None, "x"), ("y", None), ("z", "z")]
    return links + [(b, a) for a, b in links[:40]] + links[:20]


@pytest.mark.parametrize("rounds", [12, 1])
def test_equals_union_find(spark, rounds):
    links = graph(1)
    df = spark.createDataFrame(links, "a string, b string").selectExpr("*", "1 as v", "'q' as name", "2 as src")
    got = [tuple(r) for r in components.connected_components(df, rounds).collect()]
    assert len(got) == len(set(got)) and set(got) == union_find(links)


def test_giant_longer_than_the_frontier_rounds(spark):
    links = [(f"{i * 37 % 101:03d}", f"{(i + 1) * 37 % 101:03d}") for i in range(100)] + [("a", "b")]
    got = {tuple(r) for r in components.connected_components(spark.createDataFrame(links, "a string, b string"), 3).collect()}
    assert got == union_find(links)


def test_no_links(spark):
    for rows in ([], [("a", "a"), (None, None)]):
        assert components.connected_components(spark.createDataFrame(rows, "a string, b string")).collect() == []


def test_links_of_tables(spark):
    nan = float("nan")
    estimate = spark.createDataFrame([("a", "b", 95.0, 30.0), ("a", "c", nan, 40.0), ("a", "d", 99.0, nan), ("a", "e", None, 99.0), ("f", "g", 99.0, 29.9), ("h", "h", 99.0, 99.0)], "sag1 string, sag2 string, ani double, af_ref double")
    hit = spark.createDataFrame([("p__q__r1", "s__t|r2", 0, 9, 10), ("p__q|r1", "u__v__r2", 0, 8, 10), ("p__q|r", "w", 0, 10, 10), ("x|r", "y|r", 0, None, 10)], "q string, t string, qs int, qe int, ql int")
    links = components.sag_links(estimate, hit)
    assert {tuple(r) for r in components.connected_components(links).collect()} == {("a", "a"), ("a", "b"), ("p__q", "p__q"), ("p__q", "s__t")}
