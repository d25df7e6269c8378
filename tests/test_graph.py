import random

import numpy as np

from seqloom.operators import audit, evidence, graph, triangle
from seqloom.plans.catalog import CATALOG

EDGES = "a string, b string, weight double"


def planted():
    rng = random.Random(2)
    groups = [[f"{g}{i:02d}" for i in range(10)] for g in "abc"]
    pos = [(x, y, 1.0) for g in groups for x in g for y in g if x < y and rng.random() < 0.8]
    pos += [(groups[0][0], groups[1][0], 0.3), (groups[1][1], groups[2][1], 0.3)]
    return groups, pos


def parts(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.point, r.community), set()).add(r.node)
    return out


def test_planted_groups(spark):
    groups, pos = planted()
    nodes = spark.createDataFrame([(n,) for g in groups for n in g] + [("lone",), ("lone",), (None,)], "node string")
    found = parts(graph.communities(nodes, spark.createDataFrame(pos + pos[:3] + [("a00", "a00", 9.0), (None, "a00", 1.0)], EDGES)))
    assert sorted(map(sorted, found.values())) == sorted([*map(sorted, groups), ["lone"]])


def test_repulsion_splits_and_order_does_not_matter(spark):
    x, y = [f"x{i}" for i in range(6)], [f"y{i}" for i in range(6)]
    pos = [(a, b, 1.0) for g in (x, y) for a in g for b in g if a < b] + [(a, b, 0.55) for a in x for b in y if (int(a[1]) + int(b[1])) % 2]
    neg = [(a, b, 1.0) for a in x[:4] for b in y[:4]]
    nodes = spark.createDataFrame([(n,) for n in x + y], "node string")
    one = parts(graph.communities(nodes, spark.createDataFrame(pos, EDGES), spark.createDataFrame(neg, EDGES), [(1.0, 0.0), (1.0, 30.0)]))
    flipped = [(b, a, w) for a, b, w in reversed(pos)]
    two = parts(graph.communities(nodes, spark.createDataFrame(flipped, EDGES).repartition(3), spark.createDataFrame(neg[::-1], EDGES), [(1.0, 0.0), (1.0, 30.0)]))
    assert one == two
    assert sorted(sorted(m) for (p, _), m in one.items() if p == 1) == [x, y]


def test_no_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "node string")
    none = spark.createDataFrame([], EDGES)
    assert parts(graph.communities(nodes, none, none, [(1.0, 1.0)])) == {(0, "a"): {"a"}, (0, "b"): {"b"}}
    assert graph.components(none).collect() == []


def test_communities_of_a_long_path_are_settled(spark):
    names = [f"n{i:03d}" for i in range(120)]
    pos = [(a, b, 1.0) for a, b in zip(names, names[1:])]
    found = parts(graph.communities(spark.createDataFrame([(n,) for n in names], "node string"), spark.createDataFrame(pos, EDGES)))
    at = {n: c for (_, c), members in found.items() for n in members}
    k = {n: sum(n in e[:2] for e in pos) for n in names}
    total = {c: sum(k[n] for n in at if at[n] == c) for c in set(at.values())}
    links = {}
    for a, b, _ in pos:
        links[at[a], at[b]] = links.get((at[a], at[b]), 0) + 1
    assert all(n <= total[c] * total[e] / sum(k.values()) + 1e-9 for (c, e), n in links.items() if c != e)  # no two communities gain by being one


def signed_graph(rng, n, groups):
    """Edges of planted groups with chords between them, and repulsion across."""
    at = {f"v{i:03d}": rng.randrange(groups) for i in range(n)}
    pairs = {tuple(sorted(rng.sample(sorted(at), 2))) for _ in range(6 * n)}
    pos = [(a, b, round(rng.uniform(0.2, 1.0), 3)) for a, b in sorted(pairs) if at[a] == at[b] or rng.random() < 0.15]
    neg = [(a, b, round(rng.uniform(0.05, 0.3), 3)) for a, b in sorted(pairs) if at[a] != at[b] and rng.random() < 0.4]
    return sorted(at), pos, neg


def objective(at, pos, neg, gamma, factor):
    two_m = 2 * sum(w for *_, w in pos)
    k = {}
    for a, b, w in pos:
        k[a], k[b] = k.get(a, 0) + w, k.get(b, 0) + w
    total = {}
    for n, c in at.items():
        total[c] = total.get(c, 0) + k.get(n, 0)
    inside = sum(2 * w for a, b, w in pos if at[a] == at[b]) - factor * sum(2 * w for a, b, w in neg if at[a] == at[b])
    return inside - gamma / two_m * sum(t * t for t in total.values())


def sequential(rng, nodes, pos, neg, gamma, factor):
    """The objective of moving one node after the other, in a seeded order, until none gains."""
    at, links, k = {n: n for n in nodes}, {n: {} for n in nodes}, dict.fromkeys(nodes, 0.0)
    two_m = 2 * sum(w for *_, w in pos)
    for rows, sign in ((pos, 1), (neg, -factor)):
        for a, b, w in rows:
            links[a][b], links[b][a] = links[a].get(b, 0) + sign * w, links[b].get(a, 0) + sign * w
            if sign == 1:
                k[a], k[b] = k[a] + w, k[b] + w
    total, moved = dict(k), True
    while moved:
        moved = False
        for n in rng.sample(nodes, len(nodes)):
            total[at[n]] -= k[n]
            gain = {at[n]: 0.0}
            for m, w in links[n].items():
                gain[at[m]] = gain.get(at[m], 0) + w
            best = max(gain, key=lambda c: (gain[c] - gamma * k[n] * total[c] / two_m, c == at[n]))
            moved |= best != at[n]
            at[n] = best
            total[best] += k[n]
    return objective(at, pos, neg, gamma, factor)


def test_communities_are_as_good_as_one_move_after_the_other_and_alike_in_tasks_and_joins(spark):
    rng = random.Random(21)
    nodes, pos, neg = signed_graph(rng, 30, 4)
    frames = spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(pos, EDGES), spark.createDataFrame(neg, EDGES)
    points = [(1.0, 1.0), (2.0, 10.0)]
    near = graph.communities(*frames, points)
    assert audit.same_rows(near, graph.communities(*frames, points, local_edges=10))
    found = parts(near)
    for i, (gamma, factor) in enumerate(points):
        at = {n: c for (p, c), members in found.items() if p == i for n in members}
        assert objective(at, pos, neg, gamma, factor) >= max(sequential(random.Random(seed), nodes, pos, neg, gamma, factor) for seed in range(5)) * 0.98


def test_many_nodes_settle():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 3000, 20_000), rng.integers(0, 3000, 20_000)
    a, b = a[a != b], b[a != b]
    w = rng.uniform(-0.2, 1.0, len(a))
    arrays = graph._Arrays(np.concatenate((a, b)), np.concatenate((b, a)), np.tile(w, 2), np.bincount(np.concatenate((a, b)), np.tile(np.maximum(w, 0), 2), 3000), 1 / (2 * w.clip(0).sum()), rng.integers(0, 2**63, 3000).astype(np.uint64))
    comm = arrays.settled(1000)
    assert not (arrays.wishes(comm)[1] > 1e-6).any()


def test_purity_and_selection(spark):
    members = spark.createDataFrame([("c1", f"a{i}") for i in range(10)] + [("c2", f"b{i}") for i in range(9)], "cluster string, entity string")
    pairs = spark.createDataFrame([("a0", f"a{i}", 99.0) for i in range(1, 9)] + [("a1", "a2", 96.0), ("a0", "b0", 50.0)], "a string, b string, ani double")
    assert [tuple(r) for r in evidence.cluster_purity(members, pairs).collect()] == [("c1", 10, 8, 1, 0.889, 96.0)]
    names = evidence.name_clusters(members, 9).select("name", "cluster_size").distinct().collect()
    assert {tuple(r) for r in names} == {("G0001", 10), ("G0002", 9)}
    scores = spark.createDataFrame([(0, 1, 20), (1, 2, 10), (2, 2, 10), (3, 2, 9)], "ord int, n_pure bigint, n_members bigint")
    assert evidence.select_parameters(scores).first().ord == 1


def test_similar_classes_equal_all_pairs(spark):
    rng = random.Random(6)
    base = [set(rng.sample(range(400), rng.randint(3, 30))) for _ in range(25)]
    sets = {i: set(base[i % 25]) ^ set(rng.sample(range(400), rng.choice([0, 0, 1, 2]))) | {999} for i in range(120)}  # 999 is in all
    rows = [(i, h) for i, s in sets.items() for h in s]
    classes, pairs = triangle.similar_classes(spark.createDataFrame(rows, "entity bigint, hash bigint"))
    first = {}
    want = {i: first.setdefault(frozenset(sets[i]), i) for i in sorted(sets)}
    assert {r.entity: r.class_id for r in classes.collect()} == want
    reps = sorted(set(want.values()))
    truth = {(a, b) for a in reps for b in reps if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == truth and truth


def test_all_candidates_equal_all_pairs(spark):
    rng = random.Random(8)
    sets = {i: {1, 2, 3} | set(rng.sample(range(4, 300), 12)) if i % 3 == 0 else set(rng.sample(range(4, 40), 10)) for i in range(120)}
    rows = spark.createDataFrame([(i, h) for i, s in sets.items() for h in s], "entity bigint, hash bigint")
    want = {(a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 3}
    for group in (7, 1000):
        got = triangle.all_candidates(rows, 3, group).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_shared_of_given_pairs_equals_all_candidates(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame([(i, h) for i in range(40) for h in {1, *rng.sample(range(30), 6)}], "entity bigint, hash bigint")
    every = {tuple(r) for r in triangle.all_candidates(rows, 1).collect()}
    asked = [(a, b) for a in range(40) for b in range(a + 1, 40) if (a + b) % 3 == 0] + [(0, 3), (5, 77)]
    got = triangle.shared_of(spark.createDataFrame(asked, "a bigint, b bigint"), rows).collect()
    assert len(got) == len(set(asked)) - 1 and {tuple(r) for r in got} == {x for x in every if x[:2] in set(asked)}


def test_estimates_are_of_all_similar_pairs(spark, tmp_path):
    rng = random.Random(9)
    base = "".join(rng.choice("ACGT") for _ in range(400))
    copies = [(i, "s", f"r{i}", base[:i] + "ACGT"[("ACGT".index(base[i]) + 1) % 4] + base[i + 1 :]) for i in range(46)]
    spark.createDataFrame(copies, "contig_id bigint, sag_id string, rec_name string, seq string").write.parquet(str(tmp_path / "contig.parquet"))
    assert CATALOG["ani_af_pairs"](spark, str(tmp_path)).count() == 46 * 45 // 2  # all of each contig's 45 partners


def test_audits(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    right = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "key string")
    assert {tuple(r) for r in audit.key_closure(left, right).collect()} == {("a", "missing"), ("c", "extra"), ("b", "duplicate")}
    rows = spark.createDataFrame([("k", 10), ("k", 8), ("k", 3), ("k", 0), ("j", 5)], "key string, len bigint")
    assert {tuple(r) for r in audit.n50(rows, "key", "len").collect()} == {("k", 3, 21, 8), ("j", 1, 5, 5)}
    ranked = audit.global_rank(spark.range(1000).selectExpr("cast(pmod(id * 7919, 1000) as string) as id").repartition(7), "id").collect()
    assert [r.id for r in sorted(ranked, key=lambda r: r["rank"])] == sorted(map(str, range(1000))) and sorted(r["rank"] for r in ranked) == list(range(1000))
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(2,), (1,)], "x int")
    assert audit.same_rows(a, a) and not audit.same_rows(a, b)
