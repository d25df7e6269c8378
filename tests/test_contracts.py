import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.operators import align, audit, contracts, kmers, search
from seqloom.sources import fasta, matrix


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_graph_faults(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "node string")
    edges = spark.createDataFrame([("a", "b", 0.07), ("b", "a", 0.07), ("a", "a", 0.07), ("a", "x", 0.07), ("b", "c", 0.08), (None, "c", 0.07)], "a string, b string, weight double").selectExpr("*", "'n' as node", "'f' as fault")
    got = rows(contracts.graph_faults(nodes, edges, F.lit(0.07)))
    assert got == sorted([("a", "b", "repeated_pair"), ("a", "a", "self_edge"), ("a", "x", "unknown_node"), ("b", "c", "weight_differs"), ("c", "c", "null_end")], key=str)
    with pytest.raises(ValueError, match="graph: "):
        contracts.refuse(contracts.graph_faults(nodes, edges), "graph")
    contracts.refuse(contracts.graph_faults(nodes, edges.limit(0)), "graph")


def test_difference_and_binding(spark):
    a = spark.createDataFrame([("k", 1.0), ("l", 2.0), ("m", None), (None, 1.0), ("r", 0.0), ("r", 0.0)], "key string, v double")
    b = spark.createDataFrame([("k", 1.00001), ("m", None), (None, 1.0), ("x", 3.0), ("r", 0.0)], "key string, v double")
    assert rows(contracts.difference(a, b, ["key"], {"v": (0.0, 1e-4)})) == sorted([("l", "missing"), ("x", "extra"), ("r", "repeated")], key=str)
    assert ("k", "v_differs") in rows(contracts.difference(a, b, ["key"], {"v": None}))
    held = spark.createDataFrame([("k", 5), ("q", 6)], "key string, n int")
    assert rows(contracts.bound(a.filter("key = 'k'"), held, "key").select("key", "n")) == [("k", 5)]
    with pytest.raises(ValueError, match="missing"):
        contracts.bound(a.filter("key = 'l'"), held, "key")
    with pytest.raises(ValueError, match="repeated"):
        contracts.bound(a.filter("key = 'k'"), held.union(held), "key")


def test_paths_and_headers(spark):
    known = spark.createDataFrame([("/a/x.fa", 1), ("/b/x.fa", 2), ("/c/y.fa", 3), ("/c/y.fa", 4), (None, 5)], "path string, id int")
    wanted = spark.createDataFrame([("/a/x.fa",), ("/z/x.fa",), ("/z/y.fa",), ("/n.fa",), (None,)], "path string")
    assert rows(contracts.resolved_paths(wanted, known)) == [("/a/x.fa", "path", 1), ("/n.fa", "none", None), ("/z/x.fa", "ambiguous", None), ("/z/y.fa", "name", 3)]
    headers = spark.createDataFrame([("S__1__r",), ("S|r",), ("S__1",), ("T__r",), ("S__12|r",), (None,), ("",)], "header string")
    members = spark.createDataFrame([("S",), ("S__1",), ("S__1",), (None,)], "member string")
    assert rows(contracts.header_members(headers, members)) == sorted([("S__1__r", "S__1"), ("S|r", "S"), ("S__1", "S__1"), ("T__r", None), ("S__12|r", "S"), ("", None)], key=str)
    assert spark.range(1).select(contracts.is_rejection(F.lit(" No_Hit")), contracts.is_rejection(F.lit("fine"))).first()[:] == (True, False)


def test_stored_matrix(spark, tmp_path):
    refs = spark.createDataFrame([(i, bytearray([i, 255 - i])) for i in range(40)], "ref bigint, bits binary")
    labels = refs.select("ref", F.concat(F.lit("s"), F.col("ref").cast("string")).alias("species"))
    path = str(tmp_path / "m")
    matrix.write_matrix(refs, labels, path, 2)
    got, named = matrix.load_matrix(spark, path)
    assert rows(got.select("ref", F.hex("bits"))) == rows(refs.select("ref", F.hex("bits"))) and named.count() == 40
    with pytest.raises(Exception, match="exist"):
        matrix.write_matrix(refs, labels, path, 2)
    with pytest.raises(ValueError, match="missing"):
        matrix.write_matrix(refs, labels.filter("ref > 3"), str(tmp_path / "x"), 2)
    with pytest.raises(ValueError, match="other than"):
        matrix.write_matrix(refs.withColumn("bits", F.substring("bits", 1, 1)), labels, str(tmp_path / "y"), 2)
    with pytest.raises(ValueError, match="other than"):
        matrix.query_rows(refs.withColumnRenamed("ref", "entity"))
    refs.filter("ref = 7").write.mode("append").parquet(f"{path}/rows")  # tampered with
    with pytest.raises(ValueError, match="receipt"):
        matrix.load_matrix(spark, path)


def test_stored_index(spark, tmp_path):
    sketches = spark.createDataFrame([(h, e) for h in range(30) for e in range(h % 7 + 1)], "hash bigint, entity bigint")
    path = str(tmp_path / "i")
    matrix.write_index(sketches, path, 13, 4, max_posting=5)
    postings, receipt = matrix.load_index(spark, path, k=13)
    assert receipt["max_posting"] == 5 and rows(postings) == rows(search.posting_index(sketches, 5))
    matrix.relayout_index(spark, path, f"{path}2", 3)
    assert rows(matrix.load_index(spark, f"{path}2")[0]) == rows(postings)
    with pytest.raises(ValueError, match="k is 13"):
        matrix.load_index(spark, path, k=15)
    postings.limit(1).write.mode("append").parquet(f"{path}/postings")
    with pytest.raises(ValueError, match="repeated"):
        matrix.load_index(spark, path)


def test_strict_fasta(spark):
    texts = {1: ">a x\nACGN\r\n>b\nGG", 2: "junk\n>a\nAC\n>a\n\n", 3: ">ü\nAX\n> pad \nA", 4: "", 5: None, 6: ">\nA-"}
    files = spark.createDataFrame(list(texts.items()), "path int, content string")
    want = {(2, "text_before_record", 1), (2, "repeated_name", 1), (2, "no_sequence", 1), (3, "not_ascii", 1), (3, "bad_letter", 1), (3, "padded_header", 1), (3, "no_name", 1), (4, "no_record", 1), (5, "no_record", 1), (6, "no_name", 1), (6, "bad_letter", 1)}
    assert set(rows(fasta.fasta_faults(files))) == want
    got = {r.path: r for r in fasta.fasta_digests(files).collect()}
    assert (got[1].records, got[1].bases, got[1].gc_bases, got[1].min_length, got[1].max_length) == (2, 6, 4, 2, 4)
    again = spark.createDataFrame([(1, ">b\nG\nG\n>a y\nacgn\n")], "path int, content string")
    assert fasta.fasta_digests(again).first().record_digest == got[1].record_digest


def test_digests_and_series(spark):
    df = spark.createDataFrame([("k", i, f"v{i % 5}") for i in range(50)] + [("j", 1, None), (None, 1, "x")], "key string, at int, v string").selectExpr("*", "1 as n", "'d' as digest")
    one = {r.key: r for r in audit.ordered_digest(df, "key", ["at"], F.col("v")).collect()}
    moved = df.withColumn("at", F.col("at") + 100)
    assert {r.key: r.digest for r in audit.ordered_digest(moved.repartition(5), "key", ["at"], F.col("v")).collect()} == {k: r.digest for k, r in one.items()}
    turned = df.withColumn("at", -F.col("at"))
    assert audit.ordered_digest(turned, "key", ["at"], F.col("v")).filter("key = 'k'").first().digest != one["k"].digest
    sets = {r.key: (r.n, r.digest) for r in audit.multiset_digest(df, ["key"], F.col("v")).collect()}
    assert sets == {r.key: (r.n, r.digest) for r in audit.multiset_digest(turned.repartition(3), ["key"], F.col("v")).collect()} and sets["j"][0] == 1
    assert audit.multiset_digest(df.limit(0), [], F.col("v")).first().n == 0


@pytest.mark.parametrize("stretch", [7, 1 << 16])
def test_intervals_in_stretches(spark, stretch):
    rng = random.Random(stretch)
    spans = [(rng.choice("ab"), s := rng.randint(0, 120), s + rng.randint(0, 12)) for _ in range(60)]
    df = spark.createDataFrame([*spans, ("a", None, 3), (None, 1, 4)], "t string, s int, e int")
    depth = {}
    for t, s, e in {*spans, (None, 1, 4)}:
        for p in range(s, e):
            depth.setdefault(t, {})[p] = depth.get(t, {}).get(p, 0) + 1
    islands = {t: sum(p - 1 not in d and not any(e == p and s < e for u, s, e in spans if u == t) for p in d) for t, d in depth.items()}
    assert {r.t: (r.n_islands, r.covered) for r in audit.interval_union(df, "t", "s", "e", stretch).collect()} == {t: (islands[t], len(d)) for t, d in depth.items()}
    got = {t: {} for t in depth}
    for r in audit.depth_segments(df.filter("t is not null").distinct(), "t", "s", "e", stretch).collect():
        got[r.t] |= dict.fromkeys(range(r.seg_start, r.seg_end), r.depth)
    assert {t: d for t, d in got.items() if t} == {t: d for t, d in depth.items() if t}


def test_summaries(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", 2.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert rows(audit.summary(df, ["k"], "v")) == [("a", 4, 1.0, 2.5, 4.0)]
    runs = spark.createDataFrame([("t", 1, 2.0, 5, "x"), ("t", 1, 3.0, 9, "x"), ("t", 2, 7.0, 1, "x"), ("u", 1, 1.0, 1, "x"), ("u", 2, 1.0, 1, "y")], "key string, run int, s double, p int, o string")
    assert rows(audit.run_comparison(runs, "key", "run", "s", "p", "o")) == [("t", 2, 6.0, 5.0, True), ("u", 2, 1.0, 1.0, False)]


def test_every_similar_pair_is_voted_on(spark):
    """Against all pairs, scored one by one: none with an aligned fraction of 15 percent is left out."""
    rng = random.Random(31)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    pool = [dna(400) for _ in range(6)]
    change = lambda s: "".join(rng.choice("ACGT") if rng.random() < 0.08 else c for c in s)
    back = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    seqs = [(i, dna(rng.randint(0, 200)) + rng.choice([change, lambda s: back(change(s)), lambda s: dna(300)])(rng.choice(pool)) + dna(100)) for i in range(30)]
    base = spark.createDataFrame(seqs, "entity bigint, seq string")
    every = spark.createDataFrame([(a, b) for a in range(30) for b in range(30) if a != b and b % 5 == 0], "a bigint, b bigint")
    truth = {tuple(r) for r in align.pair_estimates(every, base, min_af=15.0).select("ref", "query", "aligned").collect()}
    voted = align.voted_pairs(base.filter("entity % 5 = 0"), base)
    assert {tuple(r) for r in align.pair_estimates(voted, base, min_af=15.0).select("ref", "query", "aligned").collect()} == truth and len(truth) > 5


def test_best_estimates(spark):
    df = spark.createDataFrame([("q", "a", 99.0, 1.0, 5.0), ("q", "b", 99.0, 2.0, 1.0), ("q", "c", 98.0, 9.0, 9.0), ("q", "d", 99.0, 2.0, 1.0)], "query string, ref string, ani double, af_query double, af_ref double")
    assert [r.ref for r in search.best_estimates(df, 3).orderBy("rank").collect()] == ["b", "d", "a"]


def test_archived_votes_of_many_records_equal_those_of_one(spark):
    rng = random.Random(3)
    seqs = [(i, "".join(rng.choice("ACGTNacgt") for _ in range(rng.choice([0, 17, 18, 19, 60])))) for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(seqs, "entity bigint, seq string").coalesce(1)
    whole = rows(kmers.archived_votes(df, 101))
    apart = [r for i in (0, 7, 39) for r in map(tuple, kmers.archived_votes(df.filter(F.col("entity") == i), 101).collect())]
    assert sorted(apart, key=str) == [r for r in whole if r[0] in (0, 7, 39)]


@pytest.mark.parametrize("k", [15, 19])
def test_voted_pairs_in_blocks_are_those_of_pairs_one_by_one(spark, k):
    """Against the votes of every pair, in small and large blocks and pieces; sequences move, so the plan broadcasts and shuffles no words."""
    rng = random.Random(k)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    pool = [dna(150) for _ in range(4)] + ["A" * 90, "ACG" * 40]
    back = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    own = {i: [dna(rng.randint(0, 90)) + rng.choice([str, back])(rng.choice(pool))[rng.randint(0, 60) :] + rng.choice(["", "N", dna(30)]) for _ in range(rng.randint(1, 3))] for i in range(24)}
    df = spark.createDataFrame([(i, p, s) for i, parts in own.items() for p, s in enumerate(parts)] + [(None, 0, pool[0])], "entity bigint, part int, seq string")
    asked = df.filter("entity % 3 = 0")
    words = {e: (align.sorted_words(g, k, False, 20), align.sorted_words(g, k, True)) for e, g in own.items()}
    truth = {(a, b) for a in own for b in own if a != b and b % 3 == 0 and align.voted_spans(words[a][0], words[b][1], 3)}
    for block in (300, 4 << 20):
        found = align.voted_pairs(asked, df, k, 20, 3, block)
        assert sorted(map(tuple, found.collect())) == sorted(truth) and len(truth) > 20
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "word" not in plan and "Broadcast" not in plan
    queries = [b for b in own if b % 3 == 0]
    same = np.array([queries.index(a) if a in queries else -1 for a in own])
    for at_once in (40, 300):
        pairs = align._Words([own[b] for b in queries], k, at_once).pairs(list(own.values()), same, 20, 3)
        assert sorted((a, queries[b]) for a, b in pairs.tolist()) == sorted(truth)


def test_archived_votes_need_little_memory(spark):
    """A long record in pieces, runs of records that end anywhere, and entities with one record and with several, against all at once."""
    rng = random.Random(6)
    long = "".join(rng.choice("ACGTN") for _ in range(3000))
    column = pa.array([long, None, "ACGT" * 5, "", long[:40]], pa.string())
    slots = lambda size: sorted((int(r), int(x)) for row, h in kmers._archived_hashes(column, size) for r, x in zip(row, h))
    assert slots(1 << 19) == slots(100) == slots(17) and len(slots(100)) == 2 * (2983 + 3 + 23)
    batch = pa.RecordBatch.from_arrays([pa.array([7, 7, 8, 9, 8]), column], names=["entity", "seq"])

    def added(size):
        out = {}
        for entity, row, slot, vote in kmers._batch_votes(batch, lambda c: kmers._archived_hashes(c, 100), 101, size):
            for r, s, v in zip(row, slot, vote):
                key = entity[int(r)].as_py(), int(s)
                out[key] = out.get(key, 0) + int(v)
        return out

    assert added(1) == added(50) == added(1 << 19)
    at_once = []
    hashes = lambda c: (at_once.append(len(h)) or (row, h) for row, h in kmers._archived_hashes(c))
    many = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array([long] * 4000)], names=["entity", "seq"])
    assert sum(len(row) for _, row, _, _ in kmers._batch_votes(many, hashes, 101, kmers.PIECE)) == 4000 * 101 and max(at_once) <= kmers.PIECE
    df = spark.createDataFrame([(i % 9 if i < 15 else i, long[10 * i : 10 * i + 90]) for i in range(40)] + [(None, long)], "entity bigint, seq string")
    votes = kmers.archived_votes(df, 101)
    want = votes.groupBy("entity").agg(F.count("*"), F.count_if(F.col("vote") < 0), F.sum((F.col("slot") + 1) * F.col("vote")))
    assert rows(kmers.archived_sums(df, 101)) == rows(want) and votes.select("entity", "slot").distinct().count() == votes.count() and want.count() == 34
