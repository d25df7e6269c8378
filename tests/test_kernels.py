import random

import numpy as np
import pyarrow as pa
import pytest

from seqloom.operators import align, kmers, search

CODE = {"A": 0, "C": 1, "G": 2, "T": 3, "U": 3}


def words(seq, k):
    """(place, word) of valid windows by plain integers."""
    out = []
    s = [c for c in seq.upper() if c.isalpha()]
    for p in range(len(s) - k + 1):
        w = s[p : p + k]
        if all(c in CODE for c in w):
            f = r = 0
            for c in w:
                f = f * 4 + CODE[c]
            for c in reversed(w):
                r = r * 4 + 3 - CODE[c]
            out.append((p, min(f, r)))
    return out


def mix(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def fixture():
    rng = random.Random(3)
    return ["".join(rng.choice("ACGTacgtNRY.-\n") if rng.random() < 0.2 else rng.choice("ACGT") for _ in range(n)) for n in (0, 1, 16, 17, 18, 19, 31, 32, 65, 1001)] + ["A" * 70, "", None, "ACGU" * 9]


@pytest.mark.parametrize("k", [1, 2, 5, 11, 15, 17, 31])
def test_words(k):
    seqs = fixture()
    row, pos, word = kmers.canonical_words(pa.array(seqs, pa.string()), k)
    want = [(i, p, w) for i, s in enumerate(seqs) for p, w in words(s or "", k)]
    assert list(zip(row.tolist(), pos.tolist(), word.tolist(), strict=True)) == want
    sliced = kmers.canonical_words(pa.array(["GGG", *seqs], pa.string()).slice(1), k)
    assert (sliced[2] == word).all()


def test_sketches(spark):
    seqs = fixture()
    df = spark.createDataFrame([(i % 5, s) for i, s in enumerate(seqs)], "entity bigint, seq string").selectExpr("*", "1 as word", "2 as slot")
    votes, held = {}, set()
    for i, s in enumerate(seqs):
        for _, w in words(s or "", 11):
            h = mix(w)
            key = (i % 5, (h & ((1 << 63) - 1)) % 100)
            votes[key] = votes.get(key, 0) + (1 if h >> 63 else -1)
            if h <= (2**64 - 1) // 4:
                held.add((i % 5, h))
    assert {(r.entity, r.slot): r.vote for r in kmers.sketch_votes(df, 100, 11).collect()} == votes
    for r in kmers.bit_sketch(df, 100, 11).collect():
        on = np.unpackbits(np.frombuffer(r.bits, np.uint8))[:100]
        assert on.tolist() == [int(votes.get((r.entity, i), 0) >= 0) for i in range(100)]
    assert {tuple(r) for r in kmers.scaled_sketch(df, 11, 4).collect()} == held
    few = kmers.scaled_sketch(df, 11, 4, cap=3).collect()
    assert {tuple(r) for r in few} == {(e, h) for e in range(5) for h in sorted(x for q, x in held if q == e)[:3]}


def test_full_size_sketch_is_the_same_however_it_is_spread(spark):
    rng = random.Random(1)
    rows = [(i % 3, "".join(rng.choice("ACGT") for _ in range(400))) for i in range(30)]
    df = spark.createDataFrame(rows, "entity bigint, seq string")
    one = {r.entity: bytes(r.bits) for r in kmers.bit_sketch(df.coalesce(1)).collect()}
    many = {r.entity: bytes(r.bits) for r in kmers.bit_sketch(df.repartition(7)).collect()}
    assert one == many and all(len(b) == 6912 for b in one.values())


def test_nearest(spark):
    rng = np.random.default_rng(2)
    refs = {int(i): rng.integers(0, 4, 6).astype(np.uint8) for i in range(0, 300, 2)}
    asked = {1: refs[40], 3: rng.integers(0, 4, 6).astype(np.uint8), 40: refs[40]}
    frame = lambda d, c: spark.createDataFrame([(i, bytearray(b.tobytes())) for i, b in d.items()], f"{c} bigint, bits binary")
    got = {r.query: (r.ref, r.dist, r.second) for r in search.nearest(frame(asked, "entity"), frame(refs, "ref"), block_bytes=12).collect()}
    for q, bits in asked.items():
        best, second, low = None, search.NO_SECOND, search.NO_SECOND
        for i in sorted(refs):
            if i != q:
                d = int(np.bitwise_count(refs[i] ^ bits).sum())
                if d < low:
                    second, low, best = low, d, i
        assert got[q] == (best, low, second)


def test_acceptance(spark):
    rows = [(0, 5, True), (100, 101, False), (100, 102, True), (100, search.NO_SECOND, True), (200, 202, False), (3, 3, False)]
    df = spark.createDataFrame(rows, "dist int, second int, want boolean")
    assert all(r.got == r.want for r in df.select("want", search.accepted(df.dist, df.second).alias("got")).collect())


def full_table(q, r):
    """The same alignment by a plain table."""
    n, m = len(q), len(r)
    s = [[0] * (m + 1)] + [[i * align.GAP] + [0] * m for i in range(1, n + 1)]
    t = [[1] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d = s[i - 1][j - 1] + (align.MATCH if q[i - 1] == r[j - 1] and q[i - 1] != "N" else align.MISMATCH)
            s[i][j], t[i][j] = max((d, 0), (s[i - 1][j] + align.GAP, -1), (s[i][j - 1] + align.GAP, -2))
    i, j = n, max(range(m + 1), key=lambda j: (s[n][j], -j))
    out = []
    while i:
        move = -t[i][j] if j else 1
        if move == 0:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif move == 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def test_banded_equals_full_table():
    rng = random.Random(8)
    cases = [("A" * 9, "A" * 14), ("ACAC" * 4, "CACA" * 6), ("NNAN", "NNANN"), ("ACGT", "TTTT")]
    for _ in range(60):
        r = "".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 40)))
        q = "".join(c if rng.random() > 0.2 else rng.choice(["", "A", "CG"]) for c in r[rng.randint(0, len(r) // 2) :]) or "A"
        cases.append((q, r))
    arrays = [(np.frombuffer(q.encode(), np.uint8), np.frombuffer(r.encode(), np.uint8)) for q, r in cases]
    for (q, r), got in zip(cases, align.banded(arrays, 7), strict=True):
        assert [tuple(x) for x in got.tolist()] == full_table(q, r), (q, r)


def test_pair_estimates(spark):
    rng = random.Random(4)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    a = dna(3000)
    changed = "".join(c if i % 101 else "ACGT"[("ACGT".index(c) + 1) % 4] for i, c in enumerate(a))[200:2200]
    back = changed.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    df = spark.createDataFrame([(1, 0, a[:1500]), (1, 1, a[1500:]), (2, 0, changed), (3, 0, back), (4, 0, dna(900)), (5, 0, "NNNN"), (6, 0, None)], "entity bigint, part int, seq string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (2, 3), (1, 2)], "a bigint, b bigint")
    got = {(r.ref, r.query): r for r in align.pair_estimates(pairs, df).collect()}
    assert set(got) == {(1, 2), (1, 3), (1, 4), (1, 5), (2, 3)}
    for key in ((1, 2), (1, 3)):
        assert got[key].ani >= 97 and got[key].af_query >= 90 and got[key].af_ref >= 20
    assert got[(2, 3)].ani == 100 and got[(1, 4)].aligned == 0 and got[(1, 5)].af_query == 0


@pytest.mark.parametrize("ones", [0.004, 0.5, 0.996])
def test_nearest_in_a_block_by_odd_bits_equals_comparing_words(monkeypatch, ones):
    rng = np.random.default_rng(5)
    bits = np.packbits(rng.random((400, 1000)) < ones, axis=1)
    bits[rng.integers(0, 400, 60)] = bits[rng.integers(0, 400, 60)]  # ties
    bits[7:9] = 0 if ones < 0.5 else 255
    rows = [r.tobytes() for r in bits]
    refs = pa.table({"ref": pa.array(rng.permutation(400), pa.int64()), "bits": pa.array(rows, pa.binary()), "block": pa.array([3] * 400, pa.int64())})
    queries = pa.table({"entity": pa.array([*range(0, 400, 9), 900], pa.int64()), "bits": pa.array([rows[i] for i in range(45)] + [rows[44]], pa.binary())})
    made, plain = [], search._sparse
    monkeypatch.setattr(search, "_sparse", lambda *a: made.append(plain(*a)) or made[-1])
    got = search._block_best(None, queries, refs)
    assert (made[0] is None) == (ones == 0.5)
    monkeypatch.setattr(search, "_POSTINGS", 300)
    assert got.equals(search._block_best(None, queries, refs))
    monkeypatch.setattr(search, "_sparse", lambda *a: None)
    assert got.equals(search._block_best(None, queries, refs)) and got.num_rows == 46
