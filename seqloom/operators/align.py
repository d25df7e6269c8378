"""Identity and aligned fraction of pairs of entities, from seed votes to banded alignments.

Given pairs are voted on in the kernel, which has both sequences: their words are sorted once, met, and counted by
diagonal and strand. Where pairs are not given, blocks of sequences meet by their words and find every pair that has a
voted diagonal, which is every pair whose estimate is not 0. The kernel aligns windows along the voted spans in a band and lets the better windows
claim positions first, each position once on either side.

Defined results: letters other than A, C, G, T are no matches and not callable; an entity without callable letters has
fraction 0; a pair without an accepted window has identity 0; pairs with unknown entities are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seqfuncs as fn
from ..session import spread, written
from . import kmers

# fixed values: scores of a match, a mismatch and a gap
MATCH, MISMATCH, GAP = 2, -3, -4
_COMPLEMENT = bytes.maketrans(b"ACGTN", b"TGCAN")


def banded(windows: list[tuple[np.ndarray, np.ndarray]], at_once: int = 48) -> list[np.ndarray]:
    """Aligned position pairs of all of q within r for each window (q, r), the ends of r free.

    Ties go to the diagonal, then to a gap in r, and to the leftmost end. Windows of similar size are worked off
    together, a row of all of them at a time; a window that stands unchanged in r needs no table.
    """
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)] * len(windows)
    left = []
    for i, (q, r) in enumerate(windows):
        place = -1 if (q == 78).any() else r.tobytes().find(q.tobytes())
        if place >= 0:
            out[i] = np.stack((np.arange(len(q)), np.arange(len(q)) + place), axis=1)
        else:
            left.append(i)
    left.sort(key=lambda i: (len(windows[i][0]), len(windows[i][1])))
    for at in range(0, len(left), at_once):
        group = left[at : at + at_once]
        n, m = max(len(windows[i][0]) for i in group), max(len(windows[i][1]) for i in group)
        q, r = np.zeros((len(group), n), np.uint8), np.full((len(group), m), 1, np.uint8)
        for g, i in enumerate(group):
            q[g, : len(windows[i][0])], r[g, : len(windows[i][1])] = windows[i]
        q[q == 78] = 0  # an unknown letter equals none
        steps = (np.arange(m + 1) * GAP).astype(np.int32)
        row, moves = np.zeros((len(group), m + 1), np.int32), np.zeros((n + 1, len(group), m + 1), np.uint8)
        moves[1:, :, 0] = 1
        ends = np.zeros(len(group), np.int64)
        for k in range(1, n + 1):
            diagonal = row[:, :-1] + np.where(r == q[:, k - 1 : k], np.int32(MATCH), np.int32(MISMATCH))
            up = row[:, 1:] + np.int32(GAP)
            best = np.concatenate((np.full((len(group), 1), k * GAP, np.int32), np.maximum(diagonal, up)), axis=1)
            row = np.maximum.accumulate(best - steps, axis=1) + steps
            moves[k, :, 1:] = np.where(row[:, 1:] == diagonal, 0, np.where(row[:, 1:] == up, 1, 2))
            for g, i in enumerate(group):
                if len(windows[i][0]) == k:
                    ends[g] = row[g, : len(windows[i][1]) + 1].argmax()
        for g, i in enumerate(group):
            x, y, trace = len(windows[i][0]), int(ends[g]), moves[:, g]
            pairs = []
            while x:
                move = trace[x, y]
                if move == 0:
                    x, y = x - 1, y - 1
                    pairs.append((x, y))
                elif move == 1:
                    x -= 1
                else:
                    y -= 1
            out[i] = np.array(pairs[::-1], np.int64).reshape(-1, 2)
    return out


def estimate_pairs(pairs: list[tuple[list[bytes], list[bytes], list[dict]]], k: int, window: int, band: int, min_window: int, min_identity: float) -> list[tuple[float, float, float, int, int]]:
    """(ani, af_ref, af_query, aligned, matches) of each pair (query's sequences, ref's sequences, voted spans (qi, ri, d, rev, n, low, high))."""
    windows, places, held = [], [], []
    for p, (query, ref, spans) in enumerate(pairs):
        sides = {rev: [np.frombuffer(s.translate(_COMPLEMENT)[::-1] if rev else s, np.uint8) for s in query] for rev in (False, True)}
        refs = [np.frombuffer(s, np.uint8) for s in ref]
        held.append((sides, refs))
        for v in spans:
            q, r = sides[v["rev"]][v["qi"]], refs[v["ri"]]
            low, high = max(0, -v["d"], v["low"] - band), min(len(q), len(r) - v["d"], v["high"] + k + band)
            for a in range(low, high, window):
                b = min(high, a + window)
                at = max(0, a + v["d"] - band)
                part = r[at : min(len(r), b + v["d"] + band)]
                if len(part):
                    windows.append((q[a:b], part))
                    places.append((p, v, a, at))
    found: list[list] = [[] for _ in pairs]
    for (p, v, a, at), aligned in zip(places, banded(windows)):
        q, r = held[p][0][v["rev"]][v["qi"]], held[p][1][v["ri"]]
        both = aligned + (a, at)
        both = both[(q[both[:, 0]] != 78) & (r[both[:, 1]] != 78)]
        equal = q[both[:, 0]] == r[both[:, 1]]
        if len(both) >= min_window and 100.0 * equal.sum() / len(both) >= min_identity:
            x = len(q) - 1 - both[:, 0] if v["rev"] else both[:, 0]
            found[p].append((-100.0 * equal.sum() / len(both), -len(both), -v["n"], v["qi"], v["ri"], v["rev"], a, v["d"], x, both[:, 1], equal))
    return [_claimed(query, ref, sorted(c, key=lambda c: c[:8]), min_window) for (query, ref, _), c in zip(pairs, found)]


def _claimed(query: list[bytes], ref: list[bytes], windows: list[tuple], min_window: int) -> tuple[float, float, float, int, int]:
    """The estimate after better windows have claimed their positions first."""
    took_q, took_r = [np.zeros(len(s), bool) for s in query], [np.zeros(len(s), bool) for s in ref]
    aligned = matches = 0
    for _, _, _, qi, ri, _, _, _, x, y, equal in windows:
        fresh = ~took_q[qi][x] & ~took_r[ri][y]
        n = int(fresh.sum())
        if n < min_window // 2 or 2 * n < len(x):
            continue
        took_q[qi][x[fresh]] = True
        took_r[ri][y[fresh]] = True
        aligned += n
        matches += int(equal[fresh].sum())
    callable_ = [sum(len(s) - s.count(b"N") for s in side) for side in (ref, query)]
    return (100.0 * matches / aligned if aligned else 0.0, *(100.0 * aligned / c if c else 0.0 for c in callable_), aligned, matches)


def sorted_words(parts: list[str], k: int, both: bool, max_occ: int | None = None) -> tuple[np.ndarray, ...]:
    """(word, part, place, reverse) in the order of words, without those that occur more than max_occ times."""
    part, pos, word, rev = kmers.strand_words(pa.array(parts, pa.string()), k, both)
    order = np.argsort(word, kind="stable")
    part, pos, word, rev = part[order], pos[order], word[order], rev[order]
    if max_occ is not None and len(word):
        _, at, n = np.unique(word, return_inverse=True, return_counts=True)
        kept = n[at] <= max_occ
        part, pos, word, rev = part[kept], pos[kept], word[kept], rev[kept]
    return word, part, pos, rev


def voted_spans(ref: tuple[np.ndarray, ...], query: tuple[np.ndarray, ...], min_seed_hits: int) -> list[dict]:
    """Diagonals (qi, ri, rev, d, n, low, high) with enough equal words; ref and query are sorted_words."""
    word, ri, rp, _ = ref
    low, high = np.searchsorted(word, query[0], side="left"), np.searchsorted(word, query[0], side="right")
    n = high - low
    if not n.any():
        return []
    q = np.repeat(np.arange(len(n)), n)
    r = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    qi, qp, rev, ri, d = query[1][q], query[2][q], query[3][q], ri[r], rp[r] - query[2][q]
    order = np.lexsort((qp, d, rev, ri, qi))
    qi, qp, rev, ri, d = qi[order], qp[order], rev[order], ri[order], d[order]
    new = np.ones(len(qi), bool)
    new[1:] = (qi[1:] != qi[:-1]) | (ri[1:] != ri[:-1]) | (rev[1:] != rev[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(qi)) - 1
    enough = last - first + 1 >= min_seed_hits
    return [{"qi": int(qi[a]), "ri": int(ri[a]), "rev": bool(rev[a]), "d": int(d[a]), "n": int(b - a + 1), "low": int(qp[a]), "high": int(qp[b])} for a, b in zip(first[enough], last[enough])]


def records_by_entity(records: DataFrame) -> DataFrame:
    """(entity, g array<string>): callable sequences of records (entity, seq [, part]) in the order of part."""
    if "part" not in records.columns:
        records = records.withColumn("part", F.lit(0))
    parts = records.select("entity", "part", fn.callable_bases(F.col("seq")).alias("seq")).filter("seq <> ''")
    listed = parts.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("part", "seq"))).alias("g"))  # one entity's own records
    return listed.select("entity", F.col("g.seq").alias("g"))


def _genomes(records: DataFrame) -> DataFrame:
    """records_by_entity, written; records that are so already stay."""
    return records if "g" in records.columns else written(records_by_entity(records), "genomes")


def _pieces(genomes: list[list[str]], k: int, size: int) -> Iterator[list[tuple[int, int, int, int, str]]]:
    """Lists of (genome, part, start, length of the part, letters) of about size letters; longer parts are cut so that every window is in one piece."""
    held, n = [], 0
    for e, parts in enumerate(genomes):
        for p, s in enumerate(parts):
            for at in range(0, max(1, len(s) - k + 1), size):
                held.append((e, p, at, len(s), s[at : at + size + k - 1]))
                n += len(held[-1][4])
                if n >= size:
                    yield held
                    held, n = [], 0
    if held:
        yield held


def _piece_words(held: list[tuple[int, int, int, int, str]], k: int, both: bool) -> tuple[np.ndarray, ...]:
    """(genome, part, place, word, reverse) of the windows of pieces; places are those in the whole part, or in its reverse complement."""
    row, pos, word, rev = kmers.strand_words(pa.array([x[4] for x in held], pa.string()), k, both)
    genome, part, start, whole, own = np.array([(*x[:4], len(x[4])) for x in held], np.int64).reshape(-1, 5).T
    return genome[row], part[row], pos + np.where(rev, (whole - own - start)[row], start[row]), word, rev


class _Words:
    """Words of queries on both strands, sorted, to meet the words of references with.

    Entries lie in the order of queries; the upper half of a key is the word, or a hash of one that is longer, the lower
    half the entry. A table by hash tells most words that are not there.
    """

    def __init__(self, queries: list[list[str]], k: int, at_once: int):
        self.k, self.at_once = k, at_once
        found = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64))]
        for held in _pieces(queries, k, at_once):
            genome, part, pos, word, rev = _piece_words(held, k, True)
            order = np.argsort(genome, kind="stable")
            found.append(((genome[order]).astype(np.int32), (2 * part + rev)[order].astype(np.int32), pos[order].astype(np.int32), word[order]))
        self.genome, self.strand, self.pos, word = (np.concatenate(c) for c in zip(*found))
        self.word = None if k <= 16 else word
        self.bits = min(26, max(10, (16 * len(word)).bit_length()))
        self.there = np.zeros(1 << self.bits, bool)
        self.there[self.place(self.top(word))] = True
        self.key = (self.top(word) << np.uint64(32)) | np.arange(len(word), dtype=np.uint64)
        self.key.sort()

    def top(self, word: np.ndarray) -> np.ndarray:
        return word if self.k <= 16 else kmers.mix64(word) >> np.uint64(32)

    def place(self, top: np.ndarray) -> np.ndarray:
        return ((top * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - self.bits)

    def range_of(self, top: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys of words lie, of the entries from first to before last."""
        top = top << np.uint64(32)
        return np.searchsorted(self.key, top | np.uint64(first)), np.searchsorted(self.key, top | np.uint64(last))

    def pairs(self, refs: list[list[str]], same: np.ndarray, max_occ: int, min_seed_hits: int) -> np.ndarray:
        """(reference, query) numbers of voted pairs; same has the number of the query that a reference itself is, or -1."""
        out, left, n = [np.zeros((0, 2), np.int64)], [], 0
        for held in _pieces(refs, self.k, self.at_once):
            genome, part, pos, word, _ = _piece_words(held, self.k, False)
            top = self.top(word)
            at = np.flatnonzero(self.there[self.place(top)])
            at = at[np.argsort(top[at])]
            low, high = self.range_of(top[at], 0, len(self.genome))
            at = at[high > low]
            left.append((genome[at], part[at], pos[at], word[at]))
            n += len(at)
            if n >= self.at_once:  # the last reference may go on
                columns = [np.concatenate(c) for c in zip(*left)]
                over = columns[0] < held[-1][0]
                out += self._of(*(c[over] for c in columns), same, max_occ, min_seed_hits)
                left = [tuple(c[~over] for c in columns)]
                n = len(left[0][0])
        if left:
            out += self._of(*(np.concatenate(c) for c in zip(*left)), same, max_occ, min_seed_hits)
        return np.concatenate(out)

    def _of(self, genome, part, pos, word, same, max_occ, min_seed_hits) -> list[np.ndarray]:
        """Voted pairs of all hits of some references."""
        order = np.lexsort((word, genome))
        genome, part, pos, word = genome[order], part[order], pos[order], word[order]
        new = np.ones(len(genome), bool)
        new[1:] = (genome[1:] != genome[:-1]) | (word[1:] != word[:-1])
        occ = np.diff(np.append(np.flatnonzero(new), len(genome)))
        kept = np.repeat(occ <= max_occ, occ)
        hits = [c[kept] for c in (genome, part, pos, word)]
        out, todo = [], [(0, len(hits[0]), 0, len(self.genome))]
        while todo:
            h0, h1, first, last = todo.pop()
            g, p, r, w = (c[h0:h1] for c in hits)
            low, high = self.range_of(self.top(w), first, last)
            n = high - low
            if n.sum() > 4 * self.at_once:  # by references, then by queries
                if g[0] != g[-1]:
                    mid = h0 + (int(np.searchsorted(g, g[len(g) // 2])) or int(np.searchsorted(g, g[0], "right")))
                    todo += [(h0, mid, first, last), (mid, h1, first, last)]
                    continue
                own = self.genome[first:last]
                if own[0] != own[-1]:
                    mid = first + (int(np.searchsorted(own, own[len(own) // 2])) or int(np.searchsorted(own, own[0], "right")))
                    todo += [(h0, h1, first, mid), (h0, h1, mid, last)]
                    continue
            hit = np.repeat(np.arange(len(n)), n)
            entry = (self.key[np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            met = same[g[hit]] != self.genome[entry]
            if self.word is not None:
                met &= self.word[entry] == w[hit]
            hit, entry = hit[met], entry[met]
            columns = g[hit], self.genome[entry], p[hit], self.strand[entry], r[hit] - self.pos[entry]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            start = np.flatnonzero(new)
            start = start[np.diff(np.append(start, len(order))) >= min_seed_hits]
            out.append(np.unique(np.stack((columns[0][start], columns[1][start]), axis=1).astype(np.int64), axis=0))
        return out


def voted_pairs(queries: DataFrame, records: DataFrame, k: int = 15, max_occ: int = 64, min_seed_hits: int = 3, block_letters: int = 4 << 20) -> DataFrame:
    """(a, b): every pair of an entity a of records and another entity b of queries that has a voted diagonal.

    Without such a diagonal no window is aligned and the estimate is 0, so these are all pairs worth scoring. Sequences
    move and not their words: queries lie in blocks of about block_letters, references in blocks of up to four times as
    many, a pair of blocks is one task's work, and words are made and met in it. So nothing is broadcast, and the
    references move once for every block of queries. A word's places are bounded by max_occ in each a.
    """
    kind = records.schema["entity"].dataType.simpleString()
    genomes = _genomes(records).filter("entity is not null")
    asked = written(genomes.join(queries.select("entity").distinct(), "entity", "left_semi").select("entity", "g"), "asked")
    letters = lambda df: df.agg(F.sum(F.aggregate("g", F.lit(0).cast("bigint"), lambda n, s: n + F.length(s)))).first()[0] or 0
    n_asked, n_held = letters(asked), letters(genomes)
    n_q = max(1, -(-n_asked // block_letters))
    # a block of references is worth the words of a block of queries
    n_r = max(1, -(-n_held // (4 * block_letters)), min(spread(genomes.sparkSession), -(-n_held * n_q // max(1, 4 * n_asked))))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    task = (F.col("q") * n_r + F.col("r")).cast("int").alias("task")
    left = asked.withColumn("q", F.pmod(F.xxhash64("entity"), F.lit(n_q))).withColumn("r", every(n_r)).select(task, "entity", "g")
    right = genomes.withColumn("r", F.pmod(F.xxhash64("entity", F.lit(1)), F.lit(n_r))).withColumn("q", every(n_q)).select(task, "entity", "g")

    def run(queries: pa.Table, refs: pa.Table) -> pa.Table:
        b, a = queries.column("entity"), refs.column("entity")
        found = np.zeros((0, 2), np.int64)
        if len(a) and len(b):
            number = {e: i for i, e in enumerate(b.to_pylist())}
            same = np.array([number.get(e, -1) for e in a.to_pylist()], np.int64)
            found = _Words(queries.column("g").to_pylist(), k, 1 << 19).pairs(refs.column("g").to_pylist(), same, max_occ, min_seed_hits)
        return pa.table([a.take(pa.array(found[:, 0])), b.take(pa.array(found[:, 1]))], names=["a", "b"])

    n = n_q * n_r
    return left.repartitionById(n, "task").groupBy("task").cogroup(right.repartitionById(n, "task").groupBy("task")).applyInArrow(run, f"a {kind}, b {kind}")


def pair_estimates(pairs: DataFrame, records: DataFrame, k: int = 15, window: int = 500, band: int = 128, min_window: int = 100, min_identity: float = 70.0, max_occ: int = 64, min_seed_hits: int = 3, min_af: float = 0.0) -> DataFrame:
    """(ref, query, ani, af_ref, af_query, aligned, matches) of pairs (a, b) over records (entity, seq [, part]) or records_by_entity.

    A pair is kept if the larger of its fractions reaches min_af. Records of an entity are its parts, in the order of part.
    """
    kind = records.schema["entity"].dataType.simpleString()
    genomes = _genomes(records)
    known = pairs.select("a", "b").distinct()
    held = known.join(genomes.select(F.col("entity").alias("a"), F.col("g").alias("ref")), "a").join(genomes.select(F.col("entity").alias("b"), F.col("g").alias("query")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                a, b, ref, query = whole.slice(at, 64).columns
                work = []
                for name, r, q in zip(a.to_pylist(), ref.to_pylist(), query.to_pylist()):
                    if own != name:  # rows of one reference come together
                        own, words = name, sorted_words(r, k, False, max_occ)
                    work.append(([x.encode() for x in q], [x.encode() for x in r], voted_spans(words, sorted_words(q, k, True), min_seed_hits)))
                columns = list(zip(*estimate_pairs(work, k, window, band, min_window, min_identity))) or [()] * 5
                yield pa.RecordBatch.from_arrays([a, b, *(pa.array(c, pa.float64()) for c in columns[:3]), *(pa.array(c, pa.int64()) for c in columns[3:])], names=["ref", "query", "ani", "af_ref", "af_query", "aligned", "matches"])

    # the kernel is far dearer than its rows are large, so they are spread by number; a reference with very many pairs is in several tasks
    spread_out = held.select("a", "b", "ref", "query").repartition(4 * spread(pairs.sparkSession), "a", F.pmod(F.xxhash64("b"), F.lit(8))).sortWithinPartitions("a")
    scored = spread_out.mapInArrow(run, f"ref {kind}, query {kind}, ani double, af_ref double, af_query double, aligned bigint, matches bigint")
    return scored.filter(F.greatest("af_ref", "af_query") + 1e-12 >= min_af)
