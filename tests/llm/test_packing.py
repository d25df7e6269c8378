import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from seqloom.llm import packing


def check(rows, sizes, capacity):
    """Every item whole, in order, cut only where longer than a container; no container over its capacity. Number of containers."""
    fill, pieces = Counter(), defaultdict(list)
    for r in rows:
        fill[r.container_id] += r.length
        pieces[r.item_id].append((r.piece, r.start, r.length))
    assert max(fill.values(), default=0) <= capacity
    assert set(pieces) == set(sizes)
    for i, size in sizes.items():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (k, at)
            at += length
        assert at == (size or 0)
        assert len(pieces[i]) == max(1, -(-(size or 0) // capacity))
    return len([c for c, n in fill.items() if n])


def packed(spark, sizes, capacity=64, kinds=16):
    df = spark.createDataFrame(list(sizes.items()), "item_id bigint, size int").selectExpr("*", "'x' as bin", "1 as part", "2 as length")
    return packing.pack_items(df, capacity, kinds).collect()


def test_fit_is_non_negative_and_best():
    rng = np.random.default_rng(3)
    a, b = rng.random((12, 30)), rng.random(12) * 9
    x = packing.non_negative_least_squares(a, b)
    assert (x >= 0).all()
    slope = a.T @ (b - a @ x)
    assert slope.max() < 1e-6 and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_plan_holds_the_histogram():
    rng = random.Random(1)
    for kinds in (4, 12, 40) * 7:
        histogram = {b: rng.choice([0, 1, 3, 50, 2000]) for b in range(1, 33)}
        held = Counter()
        for contents, n in packing.plan(histogram, 32, kinds):
            assert n > 0 and sum(x * m for x, m in contents.items()) <= 32
            for x, m in contents.items():
                held[x] += n * m
        assert held == Counter({b: n for b, n in histogram.items() if n})


@pytest.mark.parametrize(("histogram", "containers"), [({682: 3000}, 1000), ({409: 1000}, 200), ({1: 4096}, 2), ({2048: 7, 1: 1}, 8), ({1025: 10, 1023: 10}, 10), ({1000: 6, 48: 3, 700: 3, 648: 3}, 5)])
def test_no_container_more_than_needed(histogram, containers):
    assert sum(n for _, n in packing.plan(histogram, 2048)) == containers


def test_plan_wastes_less_than_one_percent():
    rng = np.random.default_rng(4)
    lengths, n = np.unique(np.clip(np.exp(rng.normal(5.7, 0.8, 50_000)).astype(int), 1, 2048), return_counts=True)
    histogram = dict(zip(lengths.tolist(), n.tolist()))
    assert sum(k for _, k in packing.plan(histogram, 2048)) <= 1.01 * (lengths * n).sum() / 2048


def test_items(spark):
    rng = random.Random(2)
    sizes = {i: rng.choice([None, 0, 1, 5, 63, 64, 65, 200, rng.randint(1, 64)]) for i in range(3000)}
    n = check(packed(spark, sizes), sizes, 64)
    assert n <= 1.01 * sum(s or 0 for s in sizes.values()) / 64 + 1


def test_one_size_holds_most_items(spark):
    sizes = {i: 22 if i % 3 else 20 for i in range(2000)}
    assert check(packed(spark, sizes), sizes, 64) <= 1000 - 333  # two of 22 and one of 20, or three of 20


def test_a_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 100)
    sizes = {i: 22 if i % 3 else 20 for i in range(2000)}
    assert check(packed(spark, sizes), sizes, 64) == 667


def test_empty_and_bare(spark):
    assert packed(spark, {}) == []
    assert [(r.item_id, r.length, r.container_id) for r in packed(spark, {5: 0})] == [(5, 0, 0)]


def test_documents(spark):
    folder = "/root/testdata/sf0.01"
    sizes = {r.item_id: r.size for r in packing.document_sizes(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    rows = packing.p8_packed(spark, folder).withColumnRenamed("doc_id", "item_id").collect()
    n = check(rows, sizes, packing.CAPACITY)
    assert n <= 1.01 * sum(sizes.values()) / packing.CAPACITY + 1
