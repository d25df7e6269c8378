import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from seqloom.llm import spans


def brute(seqs, span):
    """Maximal runs of positions in a stretch of span letters that another record holds too."""
    held = {}
    for i, s in seqs.items():
        for p in range(len(s) - span + 1):
            held.setdefault(s[p : p + span], set()).add(i)
    out = set()
    for i, s in seqs.items():
        on = np.zeros(len(s) + 1, bool)
        for p in range(len(s) - span + 1):
            if len(held[s[p : p + span]]) > 1:
                on[p : p + span] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], on)).astype(int)))
        out |= {(i, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)}
    return out


def fixture(seed):
    rng = random.Random(seed)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    pool = [dna(rng.randint(20, 200)) for _ in range(6)] + ["N" * 90, "ACAC" * 30, "A" * 100]
    seqs = {i: "".join(rng.choice(pool) if rng.random() < 0.6 else dna(rng.randint(1, 60)) for _ in range(rng.randint(0, 9))) for i in range(60)}
    seqs |= {100 + i: seqs[3] for i in range(9)}  # copies
    return seqs


@pytest.mark.parametrize(("seed", "most"), [(1, 12), (2, 2), (3, 10**6)])
def test_equals_brute_force(spark, seed, most):
    seqs = fixture(seed)
    rng = random.Random(seed)
    rows = []
    for i, s in seqs.items():
        dirty = "".join(c + rng.choice(["", "", "", "\n", " ", "-"]) for c in s)
        rows.append((i, rng.choice([dirty, dirty.lower()])))
    df = spark.createDataFrame(rows + rows[:15] + [(900, None), (901, ""), (902, "*-\n")], "contig_id bigint, seq string").selectExpr("*", "1 as seed", "'x' as same", "2 as e")
    got = [tuple(r) for r in spans.shared_spans(df, span=40, k=12, most=most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(seqs, 40)


def test_one_stretch_in_most_records(spark):
    rng = random.Random(9)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    hot = dna(150)
    seqs = {i: dna(rng.randint(0, 50)) + (hot if i % 3 == 0 else dna(150)) + dna(rng.randint(0, 50)) for i in range(240)}
    got = {tuple(r) for r in spans.shared_spans(spark.createDataFrame(list(seqs.items()), "contig_id bigint, seq string")).collect()}
    assert got == brute(seqs, 120)


def test_parts_of_long_records():
    rng = np.random.default_rng(4)
    old, spans.PART = spans.PART, 500
    try:
        letters = rng.choice(np.frombuffer(b"ACGT", np.uint8), 5000)
        offsets = np.array([0, 100, 100, 3000, 3050, 5000])
        cut = {(int(r), int(p), int(s)) for r, p, s in zip(*spans.minimizers(letters, offsets, 12, 40), strict=True)}
    finally:
        spans.PART = old
    whole = {(int(r), int(p), int(s)) for r, p, s in zip(*spans.minimizers(letters, offsets, 12, 40), strict=True)}
    assert cut == whole
    for row in range(5):  # every stretch holds a seed
        a, b = offsets[row], offsets[row + 1]
        places = sorted(p for r, p, _ in whole if r == row)
        for start in range(0, b - a - 40 + 1):
            assert any(start <= p <= start + 28 for p in places)


def test_chains_take_every_segment_and_are_collinear():
    rng = random.Random(3)
    for _ in range(100):
        segments = []
        for _ in range(rng.randint(1, 12)):
            x, y, n = rng.randint(0, 300), rng.randint(0, 300), rng.randint(5, 40)
            segments.append((x, x + n, y, y + n))
        chains = spans.chain_segments(segments)
        assert sorted(i for c in chains for i in c) == list(range(len(segments)))
        for c in chains:
            for i, j in zip(c, c[1:]):
                assert segments[i][1] <= segments[j][0] and segments[i][3] <= segments[j][2]
        # the first chain scores as the best of all by plain dynamic programming
        order = sorted(range(len(segments)), key=lambda i: segments[i][0])
        best = {}
        for i in order:
            x0, x1, y0, y1 = segments[i]
            gains = [best[j] - spans.GAP_COST * (x0 - segments[j][1] + y0 - segments[j][3]) for j in best if segments[j][1] <= x0 and segments[j][3] <= y0 and max(x0 - segments[j][1], y0 - segments[j][3]) <= spans.MAX_GAP]
            best[i] = x1 - x0 + max([0.0, *gains])
        first = chains[0]
        score = sum(segments[i][1] - segments[i][0] for i in first) - sum(spans.GAP_COST * (segments[j][0] - segments[i][1] + segments[j][2] - segments[i][3]) for i, j in zip(first, first[1:]))
        assert abs(score - max(best.values())) < 1e-6


def test_passages_span_a_change(spark):
    rng = random.Random(5)
    a = "".join(rng.choice("ACGT") for _ in range(600))
    b = a[:300] + "TTTTT" + a[305:]
    rows = spans.fuzzy_passages(spark.createDataFrame([(1, a), (2, b)], "contig_id bigint, seq string")).collect()
    best = max(rows, key=lambda r: r.n_equal)
    assert best.a_start < 200 and best.a_end > 400 and best.n_equal >= best.a_end - best.a_start - 5


def test_empty(spark):
    assert spans.shared_spans(spark.createDataFrame([], "contig_id bigint, seq string")).collect() == []


def test_a_frequent_repeat_makes_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    core = dna(150)
    # a letter in twelve differs beside the repeat's core of 30 letters: no stretch of 120 letters is exact
    change = lambda s: "".join(rng.choice("ACGT") if i % 12 == 0 and not 60 <= i < 90 else c for i, c in enumerate(s))
    seqs = {i: dna(rng.randint(100, 200)) + change(core) + dna(rng.randint(100, 200)) for i in range(30)}
    seeds = {}
    for i, s in seqs.items():
        for p, h in zip(*spans.minimizers(np.frombuffer(s.encode(), np.uint8), np.array([0, len(s)]), 22, 120)[1:], strict=True):
            seeds.setdefault(int(h), set()).add(i)
    want = {(a, b) for held in seeds.values() for a in held for b in held if a < b}
    assert max(map(len, seeds.values())) > 12 and len(want) > 100
    monkeypatch.setattr(spans, "PLACES", 7)
    df = spark.createDataFrame(list(seqs.items()), "contig_id bigint, seq string")
    found = [spans.fuzzy_passages(df, 20, 22, 120, most, 0.0).collect() for most in (12, 10**6)]
    assert {tuple(sorted((r.contig_a, r.contig_b))) for r in found[0]} == want
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1]))


def test_far_matches_of_a_diagonal_are_passages_of_their_own(spark):
    rng = random.Random(13)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    x, y = dna(200), dna(200)
    seqs = [(1, x + dna(2000) + y), (2, x + dna(2000) + y)]
    rows = spans.fuzzy_passages(spark.createDataFrame(seqs, "contig_id bigint, seq string")).collect()
    assert len(rows) == 2 and all(200 <= r.n_equal <= r.a_end - r.a_start <= r.n_equal + 8 < 220 for r in rows)


def test_a_chain_returns_to_a_diagonal(spark):
    rng = random.Random(14)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    x, y, z = dna(200), dna(200), dna(200)
    # five letters more before y in one record, and five more after it in the other
    seqs = [(1, x + y + "GATCA" + z), (2, x + "TACGA" + y + z)]
    best = max(spans.fuzzy_passages(spark.createDataFrame(seqs, "contig_id bigint, seq string")).collect(), key=lambda r: r.n_equal)
    assert best.n_segments == 3 and best.n_equal == best.a_end - best.a_start - 5


def test_rows_come_from_the_chains(monkeypatch):
    rng = random.Random(1)
    a = np.frombuffer("".join(rng.choice("ACGT") for _ in range(900)).encode(), np.uint8)
    b = np.concatenate((a[:300], a[305:600], a[:7], a[600:]))
    whole = [(0, 22, 0, 22), (400, 422, 395, 417), (700, 722, 702, 724)]
    assert spans.aligned_runs(a, b, whole, 120) == [(0, 300 + spans.equal_ahead(a, b, 300, 300, 1), 0), (305 - spans.equal_ahead(a, b, 305, 300, -1), 600 + spans.equal_ahead(a, b, 600, 595, 1), -5), (600 - spans.equal_ahead(a, b, 600, 602, -1), 900, 2)]
    assert spans.aligned_runs(a, b, whole[1:], 120) == spans.aligned_runs(a, b, whole, 120)[1:]
    monkeypatch.setattr(spans, "chain_segments", lambda segments, **kw: [])
    batch = pa.RecordBatch.from_pylist([{"lo": 1, "hi": 2, "matches": [{"d": 0, "x0": 0, "last": 0, "x1": 22}], "a": zstandard.compress(a.tobytes()), "b": zstandard.compress(b.tobytes())}])
    assert sum(len(out) for out in spans._aligned(120, 99)(iter([batch]))) == 0
    monkeypatch.undo()
    assert {(s, e) for out in spans._aligned(120, 99)(iter([batch])) for s, e in zip(out["s"].to_pylist(), out["e"].to_pylist())} == {(0, spans.equal_ahead(a, b, 0, 0, 1))}


def changed(rng, s, share):
    """s with a share of letters replaced, left out or doubled."""
    out = []
    for c in s:
        u = rng.random() / share
        out.append(rng.choice("ACGT".replace(c, "")) if u < 0.8 else "" if u < 0.9 else c + c if u < 1 else c)
    return "".join(out)


def test_recall_of_passages(spark):
    """Of 200 planted passages with a twentieth of their letters changed, nine in ten are found, four fifths of each."""
    rng = random.Random(17)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows, planted = [], {}
    for i in range(200):
        core = dna(rng.randint(200, 400))
        other, lead, onward = changed(rng, core, 0.05), dna(rng.randint(0, 300)), dna(rng.randint(0, 300))
        rows += [(2 * i, lead + core + dna(100)), (2 * i + 1, onward + other + dna(50))]
        planted[2 * i] = (len(lead), len(lead) + len(core), len(onward), len(onward) + len(other))
    got = spans.fuzzy_passages(spark.createDataFrame(rows, "contig_id bigint, seq string")).collect()
    found, strange = set(), 0
    for r in got:
        (a, a0, a1), (b, b0, b1) = sorted([(r.contig_a, r.a_start, r.a_end), (r.contig_b, r.b_start, r.b_end)])
        at = planted.get(a) if b == a + 1 else None
        strange += at is None
        if at and min(a1, at[1]) - max(a0, at[0]) >= 0.8 * (at[1] - at[0]) and min(b1, at[3]) - max(b0, at[2]) >= 0.8 * (at[3] - at[2]):
            found.add(a)
    assert len(found) >= 0.9 * len(planted) and not strange


def test_a_hub_of_spans(spark):
    rng = random.Random(19)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    hub = dna(900)
    seqs = {0: hub} | {i: dna(20) + hub[(at := rng.randint(0, 700)) : at + rng.randint(100, 200)] + dna(20) for i in range(1, 150)}
    got = {tuple(r) for r in spans.shared_spans(spark.createDataFrame(list(seqs.items()), "contig_id bigint, seq string")).collect()}
    assert got == brute(seqs, 120)


def test_runs_of_a_seed_count_once():
    rows, places, seeds = np.array([0, 0, 0, 0, 0, 1, 1]), np.array([5, 6, 7, 90, 8, 6, 9]), np.array([1, 1, 1, 1, 2, 1, 2], np.uint64)
    assert spans.without_runs(rows, places, seeds, 28).tolist() == [True, False, False, True, True, True, True]


def test_unknown_bases_are_no_seeds(spark):
    rng = random.Random(23)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = [(i, dna(100) + "N" * rng.randint(300, 900) + dna(100)) for i in range(40)]
    base = spans.seeded(spark.createDataFrame(seqs, "contig_id bigint, seq string"), 20, 28, all_places=False)
    assert spans.shared_seeds(base)[0].count() == 0
