import struct

import numpy as np

from seqloom.operators import kmers
from seqloom.sources import reports


def plain_sketch(sequences, bits=55_296):
    """The stored sketch by plain integers."""
    m = (1 << 64) - 1
    s0, s1 = kmers._SECRET
    mum = lambda a, b: ((a * b) & m, (a * b) >> 64)
    mix = lambda a, b: mum(a, b)[0] ^ mum(a, b)[1]
    word = lambda w, i: int.from_bytes(w[i : i + 8], "little")
    votes = [0] * bits
    for s in sequences:
        if len(s) <= 17:
            continue
        head = s[:-1]
        other = "".join({"A": "T", "T": "A", "C": "G", "G": "C"}.get(c, "N") for c in reversed(head))
        for strand in (head.encode(), other.encode()):
            for i in range(len(strand) - 16):
                w = strand[i : i + 17]
                seed = mix(word(w, 0) ^ s1, word(w, 8) ^ mix(s0, s1))
                lo, hi = mum(word(w, 1) ^ s1, word(w, 9) ^ seed)
                h = mix(lo ^ s0 ^ 17, hi ^ s1)
                votes[(h & ((1 << 63) - 1)) % bits] += 1 if h >> 63 else -1
    out = b""
    for i in range(0, bits, 64):
        out += struct.pack("<Q", int("".join("1" if v >= 0 else "0" for v in votes[i : i + 64]), 2))
    return out


def test_stored_sketch(spark):
    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"ACGTNacgtRY.-", np.uint8)
    seqs = {i: ["".join(map(chr, rng.choice(letters, n))) for n in sizes] for i, sizes in enumerate([(0, 1, 16, 17), (18,), (19, 31, 32), (65, 1001), (300, 300)])}
    seqs[9] = ["A" * 200]
    rows = [(i, s) for i, group in seqs.items() for s in group]
    got = {r.entity: bytes(r.bits) for r in kmers.archived_sketch(spark.createDataFrame(rows, "entity bigint, seq string").repartition(3)).collect()}
    assert got == {i: plain_sketch(group) for i, group in seqs.items()}


def test_hits_and_markers(spark):
    genes = spark.createDataFrame([("e", "g1", "F1,1e-5,50;F2,0.1,20;F1,1e-9,60;"), ("e", "g2", "F1,1e-9,60"), ("e", "g3", None), ("f", "g", "")], "entity string, gene string, hits string")
    best = reports.best_per_family(reports.top_hits(genes)).collect()
    assert {(r.entity, r.family, r.gene, r.ord, r.bitscore) for r in best} == {("e", "F1", "g1", 2, 60.0), ("e", "F2", "g1", 1, 20.0)}
    rows = spark.createDataFrame([("m", "x", "y", 99.0, 100, 0), ("m", "y", "x", 97.0, 200, 1), ("m", "x", "y", 95.0, 200, 2), ("m", "x", "x", 100.0, 900, 3)], "marker string, q string, s string, pident double, length int, ord int")
    assert [tuple(r) for r in reports.longest_alignments(rows).collect()] == [("m", "x", "y", 97.0, 200)]
    marks = spark.createDataFrame([("m", "e", "A" * 149, 0), ("m", "e", "C" * 100 + " \n" + "C" * 60, 1), ("m", "e", "G" * 160, 2)], "marker string, entity string, sequence string, ord int")
    assert [(r.nt_len, r.ord) for r in reports.longest_markers(marks).collect()] == [(160, 1)]


def test_logs(spark):
    lines = spark.createDataFrame([("a", 0, "start"), ("a", 2, "[2026-09-04 10:00:05] x"), ("a", 1, "[2026-09-04 10:00:09] y"), ("b", 0, "none")], "path string, ord int, value string")
    assert [(r.path, str(r.at)) for r in reports.first_stamp(lines).collect()] == [("a", "2026-09-04 10:00:09")]
    text = ["\tUser time (seconds): 12.5", "\tSystem time (seconds): 1.25", "\tElapsed (wall clock) time (h:mm:ss or m:ss): 1:02:03", "\tMaximum resident set size (kbytes): 2048"]
    assert [tuple(r) for r in reports.resource_use(spark.createDataFrame([("p", t) for t in text], "path string, value string")).collect()] == [("p", 3723.0, 12.5, 1.25, 2048)]


def test_polishing_tables(spark):
    records = spark.createDataFrame([("c", "200 10", "GG"), ("c", "0 4", "AAAA")], "name string, comment string, seq string")
    pieces = reports.consensus_pieces(records)
    assert [tuple(r) for r in reports.composed_consensus(pieces).collect()] == [("c", 6, 6.0, "AAAAGG")]
    assert {(r.pos, r.start) for r in reports.piece_offsets(pieces).collect()} == {(0, 0), (200, 4)}
    lines = spark.createDataFrame([(0, "H\tVN"), (1, "S\te1\tAC\tdp:1"), (2, "S\te2\tG")], "ord int, value string")
    new = reports.rewritten_segments(lines, spark.createDataFrame([("e1", "TTT")], "name string, seq string")).orderBy("ord").collect()
    assert [r.value for r in new] == ["H\tVN", "S\te1\tTTT\tdp:1", "S\te2\tG"]
    hits = spark.createDataFrame([("q", "t1", 0, 50, 100, 5, 55), ("q", "t1", 50, 95, 100, 60, 105), ("q", "t2", 0, 90, 100, 0, 90), ("p", "t", 0, 90, 100, 0, 90)], "q string, t string, qs int, qe int, ql int, ts int, te int")
    assert [tuple(r) for r in reports.best_polished(hits).collect()] == [("q", "t1", 5, 105, 0.95)]
    tax = spark.createDataFrame([("GCF_000000001.1,d__B;s__x\r",), ("short",)], "value string")
    assert [tuple(r) for r in reports.fixed_width_taxonomy(tax).collect()] == [("GCF_000000001.1", "d__B;s__x")]
