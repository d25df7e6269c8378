"""Long exact spans shared between records, by collinear chaining of shared k-mer seeds.

Seeds are window minimizers: of every stretch of `span` letters at least one k-mer is taken, and which one depends on
the stretch alone, so two records that share a stretch share a seed at the same place in it. Records meet by joining
equal seeds; the matches of a pair of records are gathered by diagonal into segments, chained in order with gap costs
through a Fenwick tree, and the chains aligned: along the segments to the ends of their exact runs for the shared spans,
and across the gaps and beyond the ends for fuzzy passages, for which seeds are taken more densely.

A seed with more than MAX_OCCURRENCES places would give too many pairs. Around its places the exact stretches of
`span` letters take the seed's part: each distinct stretch links every record that holds it to one record that does,
so the number of links is that of the places, and no link between different records is lost for the shared spans,
which ask of each position only whether it is shared. Passages are of pairs, so for them the places of a frequent seed
are all joined, in groups. Records with equal letters are first made one, with its copies.

Defined results: only the letters A to Z count, in upper case; null, empty and short sequences share nothing; records
of any length are cut into overlapping parts for seeding; rows delivered twice are one record; a stretch that recurs
only within its own record is not shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import table, written

SPAN = 120
K = 22
MAX_OCCURRENCES = 12
#: places of a frequent seed that one group holds where all pairs are asked for
PLACES = 256
#: seeds of fuzzy passages: their letters, and the stretch of which each holds one
FUZZY_K, FUZZY_STRETCH = 20, 60
#: a fuzzy passage has at least SPAN letters on the longer side, of which at least this share is kept in order
LEAST_EQUAL = 0.8
#: an end is extended while matches (1) and mismatches (-2) stay this close to the best sum so far
DROP = 20
#: letters of one side that an end leaves out at once, at most
SHIFT = 4
#: letters that an end is extended by at once, at most
STRIDE = 128
MAX_GAP = 500
GAP_COST = 0.05
#: parts in which the spans of one sequence are merged before they come together
MERGE_PARTS = 32
#: letters seeded at once; the place within this many letters shares a word with the seed's rank
PART = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)

_UPPER = np.zeros(256, np.uint8)
for _c in range(65, 91):
    _UPPER[_c] = _UPPER[_c + 32] = _c
_BASE = np.zeros(256, bool)
_BASE[list(b"ACGT")] = True
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_VALUE = np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest(), "big") for i in range(256)], np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def letters_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Upper-case letters of all rows in one array, and the offsets of the rows in it."""
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = _UPPER[np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]]] if held else np.zeros(0, np.uint8)
    keep = data != 0
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets - offsets[0]]


def window_hashes(letters: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every window of the width; equal for equal windows wherever they lie."""
    n = len(letters)
    if n < width:
        return np.zeros(0, np.uint64)
    size = 1 << max(12, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _ODD, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    up, down = _powers[size]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[letters] * down[:n])))
    h = (total[width:] - total[:-width]) * up[: n - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def minimizers(letters: np.ndarray, offsets: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in row, seed) of the leftmost smallest k-mer of every stretch of span letters within a row."""
    rows, places, seeds = [], [], []
    at, last = 0, len(offsets) - 1
    while at < last:
        end = at + 1
        while end < last and offsets[end + 1] - offsets[at] <= PART:
            end += 1
        for a in range(int(offsets[at]), max(int(offsets[end]) - span + 1, int(offsets[at]) + 1), PART):  # more than one turn for a very long row only
            b = min(int(offsets[end]), a + PART + span - 1)
            h = window_hashes(letters[a:b], k)
            w = span - k + 1
            if len(h) < w:
                continue
            rank = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
            low, width = rank, 1
            while width < w:  # the minimum over windows of doubling width
                step = min(width, w - width)
                low = np.minimum(low[:-step], low[step:])
                width += step
            starts = np.arange(len(low)) + a
            row = np.searchsorted(offsets, starts, side="right") - 1
            whole = starts + span <= offsets[row + 1]
            place = np.unique((low[whole] & _PLACE).astype(np.int64))
            row = np.searchsorted(offsets, place + a, side="right") - 1
            rows.append(row)
            places.append(place + a - offsets[row])
            seeds.append(h[place])
        at = end
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rows, places, seeds = np.concatenate(rows), np.concatenate(places), np.concatenate(seeds)
    if offsets[-1] > PART:  # parts overlap, so a seed may be found twice
        order = np.lexsort((places, rows))
        rows, places, seeds = rows[order], places[order], seeds[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (places[1:] != places[:-1])
        rows, places, seeds = rows[new], places[new], seeds[new]
    return rows, places, seeds


def without_runs(rows: np.ndarray, places: np.ndarray, seeds: np.ndarray, within: int) -> np.ndarray:
    """Which seeds to keep where one recurs in its row not further than `within` after itself, as in runs of one letter: the first of each run."""
    order = np.lexsort((places, seeds, rows))
    again = np.zeros(len(rows), bool)
    again[1:] = (np.diff(rows[order]) == 0) & (seeds[order][1:] == seeds[order][:-1]) & (np.diff(places[order]) <= within)
    kept = np.ones(len(rows), bool)
    kept[order] = ~again
    return kept


def _seeded(k: int, span: int, all_places: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            letters, offsets = letters_of(batch.column(1))
            size = np.diff(offsets)
            rows, places, seeds = minimizers(letters, offsets, k, span)
            if not all_places:
                odd = np.concatenate(([0], np.cumsum(~_BASE[letters])))
                start = offsets[rows] + places
                kept = without_runs(rows, places, seeds, span) & (odd[start + k] == odd[start])
                rows, places, seeds = rows[kept], places[kept], seeds[kept]
            data = letters.tobytes()
            texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            same = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "big", signed=True) for t in texts], np.int64)
            cut = pa.array(np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same), pa.array(size.astype(np.int32)), pa.array([pack(t) for t in texts], pa.binary()), pa.ListArray.from_arrays(cut, pa.array(seeds.view(np.int64))), pa.ListArray.from_arrays(cut, pa.array(places.astype(np.int32)))],
                names=["contig_id", "same", "n", "packed", "seeds", "places"],
            )
            yield out.filter(pa.array(size >= span))

    return run


def chain_segments(segments: list[tuple[int, int, int, int]], max_gap: int = MAX_GAP, gap_cost: float = GAP_COST, weights: list[int] | None = None) -> list[list[int]]:
    """Chains of segments (x0, x1, y0, y1) that follow each other in both records, best first; each segment is in one.

    A segment scores its weight, which is its length where none is given; a link costs gap_cost a letter skipped in either record. Segments are entered into a
    Fenwick tree of prefix maxima by their end in y once their end in x is passed.
    """
    n = len(segments)
    if n == 1:
        return [[0]]
    ends = sorted({s[3] for s in segments})
    rank = {y: i + 1 for i, y in enumerate(ends)}
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (len(ends) + 1)
    score, before = [0.0] * n, [-1] * n
    waiting = sorted(range(n), key=lambda i: segments[i][1])
    passed = 0
    for i in sorted(range(n), key=lambda i: (segments[i][0], segments[i][2], i)):
        x0, x1, y0, y1 = segments[i]
        while passed < n and segments[waiting[passed]][1] <= x0:
            j = waiting[passed]
            value, r = (score[j] + gap_cost * (segments[j][1] + segments[j][3]), j), rank[segments[j][3]]
            while r < len(tree):
                tree[r] = max(tree[r], value)
                r += r & -r
            passed += 1
        best, r = (float("-inf"), -1), 0
        lo, hi = 0, len(ends)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if ends[mid] <= y0 else (lo, mid)
        r = lo
        while r:
            best = max(best, tree[r])
            r -= r & -r
        score[i] = float(weights[i] if weights else x1 - x0)
        if best[1] >= 0:
            j, gain = best[1], best[0] - gap_cost * (x0 + y0)
            if gain > 0 and max(x0 - segments[j][1], y0 - segments[j][3]) <= max_gap:
                score[i] += gain
                before[i] = j
    used, chains = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            chains.append(chain[::-1])
    return chains


def chains_of(matches: list[dict], near: int) -> list[list[tuple[int, int, int, int]]]:
    """Chains of segments (x0, x1, y0, y1) of matches (d, x0, last, x1), which are joined along a diagonal d where the next begins at most `near` after the last.

    Segments are chained by the places at which their seeds begin, since an exact run may by chance go on for some letters
    beyond a change of diagonal, so that the segments of a chain may overlap by less than a seed.
    """
    out: list[list[int]] = []
    for m in sorted(matches, key=lambda m: (m["d"], m["x0"])):
        if out and out[-1][0] == m["d"] and m["x0"] - out[-1][2] <= near:
            out[-1][2:] = m["last"], max(out[-1][3], m["x1"])
        else:
            out.append([m["d"], m["x0"], m["last"], m["x1"]])
    chains = chain_segments([(x0, last + 1, x0 + d, last + 1 + d) for d, x0, last, _ in out], weights=[x1 - x0 for _, x0, _, x1 in out])
    return [[(x0, x1, x0 + d, x1 + d) for d, x0, _, x1 in (out[i] for i in chain)] for chain in chains]


def equal_ahead(a: np.ndarray, b: np.ndarray, x: int, y: int, step: int) -> int:
    """How many letters of a from x on and of b from y on are equal; with step -1 backwards from the letters before them."""
    n = min(len(a) - x, len(b) - y) if step > 0 else min(x, y)
    at, width = 0, 64
    while at < n:
        k = min(width, n - at)
        u, v = (a[x + at : x + at + k], b[y + at : y + at + k]) if step > 0 else (a[x - at - k : x - at][::-1], b[y - at - k : y - at][::-1])
        differ = u != v
        if differ.any():
            return at + int(differ.argmax())
        at, width = at + k, 4 * width
    return n


def aligned_runs(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int, int, int]], span: int) -> list[tuple[int, int, int]]:
    """Maximal runs (start, end, diagonal) of at least span equal letters along a chain.

    Every segment is followed to the ends of the exact runs at its ends. What the segment before has covered of the same
    diagonal is not compared again.
    """
    out = []
    reached: dict[int, int] = {}
    for x0, x1, y0, y1 in chain:
        d = y0 - x0
        if reached.get(d, -1) >= x1:
            continue
        lo, hi = x0 - equal_ahead(a, b, x0, y0, -1), x1 + equal_ahead(a, b, x1, y1, 1)
        edges = np.concatenate(([-1], np.flatnonzero(a[lo:hi] != b[lo + d : hi + d]), [hi - lo]))
        long = np.flatnonzero(np.diff(edges) > span)
        out += [(lo + int(edges[i]) + 1, lo + int(edges[i + 1]), d) for i in long]
        reached[d] = hi
    return out


# letters that either side leaves out before it goes on: none, then up to SHIFT of one
_LEFT_OUT = np.array([(0, 0), *((i, 0) for i in range(1, SHIFT + 1)), *((0, i) for i in range(1, SHIFT + 1))])
_STEPS = np.arange(STRIDE)


def extension(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(letters of a, letters of b, of which equal) by which a passage goes on from the begin of a and b.

    It goes on by the best run without gaps of STRIDE letters at most, before which up to SHIFT letters of either side
    may be left out at the price of a mismatch and a half each, as long as that is worth something.
    """
    a = np.concatenate((a, np.zeros(STRIDE + SHIFT, np.uint8)))  # beyond the ends nothing is equal
    b = np.concatenate((b, np.ones(STRIDE + SHIFT, np.uint8)))
    x = y = equal = 0
    while True:
        same = a[x + _LEFT_OUT[:, :1] + _STEPS] == b[y + _LEFT_OUT[:, 1:] + _STEPS]
        score = np.cumsum(np.where(same, 1, -2), axis=1)
        ended = np.logical_or.accumulate(score < np.maximum.accumulate(np.maximum(score, 0), axis=1) - DROP, axis=1)
        score[ended] = -1
        gain = score.max(axis=1) - 3 * _LEFT_OUT.sum(axis=1)
        best = int(gain.argmax())
        if gain[best] <= 0:
            return x, y, equal
        n = int(score[best].argmax()) + 1
        x, y, equal = x + int(_LEFT_OUT[best, 0]) + n, y + int(_LEFT_OUT[best, 1]) + n, equal + int(same[best, :n].sum())


def common_letters(a: np.ndarray, b: np.ndarray) -> int:
    """Letters kept in order between two stretches (longest common subsequence), a letter of a at a time for all of b as bits of one number."""
    places: dict[int, int] = {}
    for i, x in enumerate(b.tobytes()):
        places[x] = places.get(x, 0) | 1 << i
    whole = (1 << len(b)) - 1
    left = whole
    for x in a.tobytes():
        met = left & places.get(x, 0)
        left = ((left + met) | (left - met)) & whole
    return len(b) - left.bit_count()


def aligned_passage(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int, int, int]]) -> tuple[int, ...]:
    """(start and end in a, start and end in b, number of segments, letters kept in order) of an aligned chain."""
    placed = chain[:1]
    for x0, x1, y0, y1 in chain[1:]:
        over = max(0, placed[-1][1] - x0, placed[-1][3] - y0)  # cut from the later of two that overlap
        placed.append((x0 + over, x1, y0 + over, y1))
    chain = placed
    equal = sum(int((a[s[0] : s[1]] == b[s[2] : s[3]]).sum()) for s in chain)
    equal += sum(common_letters(a[s[1] : t[0]], b[s[3] : t[2]]) for s, t in zip(chain, chain[1:]))
    back_a, back_b, same_back = extension(a[: chain[0][0]][::-1], b[: chain[0][2]][::-1])
    on_a, on_b, same_on = extension(a[chain[-1][1] :], b[chain[-1][3] :])
    return chain[0][0] - back_a, chain[-1][1] + on_a, chain[0][2] - back_b, chain[-1][3] + on_b, len(chain), equal + same_back + same_on


def _aligned(span: int, near: int, least_equal: float | None = None):
    """Exact runs of span letters of each pair of sequences, or with least_equal its passages."""
    fuzzy = least_equal is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            lo, hi, matches, packed_lo, packed_hi = batch.columns
            spans: set[tuple[int, int, int]] = set()
            passages = []
            own = None
            lists = matches.to_pylist()
            for i, (p, q) in enumerate(zip(lo.to_pylist(), hi.to_pylist())):
                if own != p:  # rows of one record mostly come together
                    own, a = p, np.frombuffer(unpack(packed_lo[i].as_py()), np.uint8)
                b = np.frombuffer(unpack(packed_hi[i].as_py()), np.uint8)
                for chained in chains_of(lists[i], near):
                    if fuzzy:
                        passage = aligned_passage(a, b, chained)
                        letters = max(passage[1] - passage[0], passage[3] - passage[2])
                        if letters >= span and passage[5] >= least_equal * letters:
                            passages.append((p, q, *passage))
                        continue
                    for s, e, d in aligned_runs(a, b, chained, span):
                        spans.add((p, s, e))
                        spans.add((q, s + d, e + d))
            if fuzzy:
                yield pa.RecordBatch.from_pylist([dict(zip(_PASSAGE, r)) for r in passages], schema=pa.schema([(c, pa.int64() if c in ("a", "b") else pa.int32()) for c in _PASSAGE]))
            else:
                columns = list(zip(*spans)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["same", "s", "e"])

    return run


_PASSAGE = ("a", "b", "a_start", "a_end", "b_start", "b_end", "n_segments", "n_equal")


def _stretches(span: int, k: int):
    """Hashes of the stretches of span letters that hold a frequent seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for same, places, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h = window_hashes(np.frombuffer(unpack(packed), np.uint8), span)
                near = np.zeros(len(h) + 1, np.int64)
                p = np.array(places)
                np.add.at(near, np.clip(p + k - span, 0, len(h)), 1)
                np.add.at(near, np.clip(p + 1, 0, len(h)), -1)
                at = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(np.full(len(at), same, np.int64)), pa.array(at.astype(np.int32))], names=["stretch", "same", "place"])

    return run


def seeded(contig: DataFrame, k: int = K, span: int = SPAN, all_places: bool = True) -> DataFrame:
    """(contig_id, same, n, packed, seeds, places) of every record with at least span letters, of runs of a seed its first place, and only seeds of A, C, G and T, or all_places.

    `same` is a 64-bit digest of the letters and stands for all records that hold exactly them; among a billion
    different sequences two would share one with a probability of 3 in 100.
    """
    return written(contig.select("contig_id", F.col("seq").cast("string").alias("seq")).mapInArrow(_seeded(k, span, all_places), "contig_id bigint, same bigint, n int, packed binary, seeds array<bigint>, places array<int>"), "seeded")


def shared_seeds(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places (seed, same, place) of seeds that different sequences hold, and these sequences (same, packed)."""
    seeds = base.select("same", F.explode(F.arrays_zip("seeds", "places")).alias("z")).select(F.col("z.seeds").alias("seed"), "same", F.col("z.places").alias("place"))
    # nine of ten seeds occur in one sequence only; they end in this combined aggregation
    shared = seeds.groupBy("seed").agg(F.min("same").alias("first"), F.max("same").alias("last")).filter("first <> last").select("seed")
    matched = written(seeds.join(shared, "seed").distinct(), "matched")
    seqs = written(base.select("same", "packed").join(matched.select("same").distinct(), "same", "left_semi").groupBy("same").agg(F.first("packed").alias("packed")), "sequences")
    return matched, seqs


def seed_links(ours: DataFrame, theirs: DataFrame, k: int, by: list[str]) -> DataFrame:
    """(lo, hi, x, d, len) of all places (by, same, place) of different sequences that are equal in the columns by."""
    left = ours.select(*by, F.col("same").alias("lo"), F.col("place").alias("x"))
    right = theirs.select(*by, F.col("same").alias("hi"), F.col("place").alias("y"))
    return left.join(right, by).filter("lo < hi").select("lo", "hi", "x", (F.col("y") - F.col("x")).alias("d"), F.lit(k).alias("len"))


def gathered(links: DataFrame, seqs: DataFrame, near: int) -> DataFrame:
    """(lo, hi, matches, packed_lo, packed_hi) of links (lo, hi, x, d, len): a pair's matches by diagonal and stretch of near letters.

    Matches of one stretch are never more than `near` apart, so they are combined before the shuffle.
    """
    stretch = F.floor(F.col("x") / near)
    parts = links.groupBy("lo", "hi", "d", stretch.alias("stretch")).agg(F.min("x").alias("x0"), F.max("x").alias("last"), F.max(F.col("x") + F.col("len")).alias("x1"))
    pairs = parts.groupBy("lo", "hi").agg(F.collect_list(F.struct("d", "x0", "last", "x1")).alias("matches"))  # bounded by the letters of the two
    return pairs.join(seqs.toDF("lo", "packed_lo"), "lo").join(seqs.toDF("hi", "packed_hi"), "hi").select("lo", "hi", "matches", "packed_lo", "packed_hi")


def matched_pairs(base: DataFrame, k: int, span: int, most: int) -> DataFrame:
    """(lo, hi, matches, packed_lo, packed_hi): pairs of different sequences with their matches by diagonal.

    Enough to tell of each position whether it is shared; of the pairs that frequent stretches make it has some only.
    """
    matched, seqs = shared_seeds(base)
    frequent = matched.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("seed")
    rare = matched.join(frequent, "seed", "left_anti")
    links = seed_links(rare, rare, k, ["seed"])

    # a place set per sequence is bounded by the sequence's length
    around = matched.join(frequent, "seed").groupBy("same").agg(F.collect_set("place").alias("places"))
    stretches = written(around.join(seqs, "same").select("same", "places", "packed").mapInArrow(_stretches(span, k), "stretch bigint, same bigint, place int"), "stretches")
    ends = stretches.groupBy("stretch").agg(F.min(F.struct("same", "place")).alias("one"), F.max(F.struct("same", "place")).alias("other")).filter("one.same <> other.same")
    star = stretches.join(ends, "stretch").withColumn("to", F.when(F.col("same") != F.col("one.same"), F.col("one")).otherwise(F.col("other")))
    forth = F.col("same") < F.col("to.same")
    star = star.select(
        F.least("same", "to.same").alias("lo"),
        F.greatest("same", "to.same").alias("hi"),
        F.when(forth, F.col("place")).otherwise(F.col("to.place")).alias("x"),
        F.when(forth, F.col("to.place") - F.col("place")).otherwise(F.col("place") - F.col("to.place")).alias("d"),
        F.lit(span).alias("len"),
    )
    return gathered(links.unionByName(star), seqs, span - k + 1)


def every_pair(base: DataFrame, k: int, near: int, most: int) -> DataFrame:
    """(lo, hi, matches, packed_lo, packed_hi): all pairs of different sequences that share a seed, however frequent it is.

    The places of a seed with more than `most` are dealt into groups of about PLACES, and every group meets every
    group as a key of its own, so no task has all pairs of a seed.
    """
    matched, seqs = shared_seeds(base)
    parts = written(matched.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("seed", F.ceil(F.col("n") / PLACES).alias("parts")), "parts")
    rare = matched.join(parts, "seed", "left_anti")
    links = seed_links(rare, rare, k, ["seed"])
    dealt = matched.join(parts, "seed").withColumn("own", F.pmod(F.xxhash64("same", "place"), "parts")).withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    hot = seed_links(dealt.withColumnsRenamed({"own": "g", "met": "h"}), dealt.withColumnsRenamed({"met": "g", "own": "h"}), k, ["seed", "g", "h"])
    return gathered(links.unionByName(hot), seqs, near)


def merged_spans(spans: DataFrame, by: list[str]) -> DataFrame:
    """(by, s, e): the union of spans (by, s, e) that overlap or touch, within the columns by."""
    order = Window.partitionBy(*by).orderBy("s", "e")
    spans = spans.withColumn("reach", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("run", F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy(*by, "run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("run")


def shared_spans(contig: DataFrame, span: int = SPAN, k: int = K, most: int = MAX_OCCURRENCES) -> DataFrame:
    """(contig_id, span_start, span_end): maximal runs of shared positions of every record."""
    base = seeded(contig, k, span)
    found = matched_pairs(base, k, span, most).mapInArrow(_aligned(span, span - k + 1), "same bigint, s int, e int")
    members = base.select("same", "contig_id", "n").distinct()
    whole = members.groupBy("same").agg(F.min("contig_id").alias("one"), F.max("contig_id").alias("other"), F.first("n").alias("e")).filter("one <> other").select("same", F.lit(0).alias("s"), "e")
    # a sequence that very many link to has its spans merged in parts first; a part then has at most one per span letters
    parts = merged_spans(found.unionByName(whole).distinct().withColumn("part", F.pmod(F.xxhash64("s", "e"), F.lit(MERGE_PARTS))), ["same", "part"])
    runs = merged_spans(parts.drop("part"), ["same"])
    return members.join(runs, "same").select("contig_id", F.col("s").alias("span_start"), F.col("e").alias("span_end"))


def fuzzy_passages(contig: DataFrame, span: int = SPAN, k: int = FUZZY_K, stretch: int = FUZZY_STRETCH, most: int = MAX_OCCURRENCES, least_equal: float = LEAST_EQUAL) -> DataFrame:
    """Aligned chains of pairs of different sequences: ends in both, number of segments and of equal letters.

    A passage has at least span letters, of which a share of least_equal is kept in order. Every pair that shares a seed is
    aligned, however many records hold the seed. a and b name sequences by the smallest contig_id that holds them; copies
    are not expanded into pairs. Seeds are of A, C, G and T, and of a
    seed's places in a short repeat only the first seeds; all letters are aligned.
    """
    base = seeded(contig, k, stretch, all_places=False)
    near = max(stretch, SPAN) - k
    chains = every_pair(base, k, near, most).mapInArrow(_aligned(span, near, least_equal), ", ".join(f"{c} {'bigint' if c in ('a', 'b') else 'int'}" for c in _PASSAGE))
    names = base.groupBy("same").agg(F.min("contig_id").alias("name"))
    named = chains.join(names.toDF("a", "contig_a"), "a").join(names.toDF("b", "contig_b"), "b")
    return named.select("contig_a", "contig_b", *_PASSAGE[2:])


def p2_found(spark, folder: str) -> DataFrame:
    return shared_spans(table(spark, folder, "contig"))


def p2_shares(spark, folder: str) -> DataFrame:
    """(contig_id, n_letters, n_shared) of every contig: how many of its letters lie in shared stretches."""
    contig = table(spark, folder, "contig")
    sizes = contig.select("contig_id", F.coalesce(F.length(F.regexp_replace("seq", "[^A-Za-z]+", "")), F.lit(0)).alias("n_letters")).distinct()
    shared = p2_found(spark, folder).groupBy("contig_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("n_shared"))
    return sizes.join(shared, "contig_id", "left").select("contig_id", "n_letters", F.coalesce("n_shared", F.lit(0)).alias("n_shared"))


def p2_passages(spark, folder: str) -> DataFrame:
    return fuzzy_passages(table(spark, folder, "contig"))


def p2_occurrences(spark, folder: str) -> DataFrame:
    """(contig_id, n_places, n_shared) of the sampled seed occurrences: places of each contig, and those whose 15 letters all lie in one shared span."""
    occ = table(spark, folder, "occ").select("contig_id", "pos").filter("contig_id is not null and pos is not null").distinct()
    spans = p2_found(spark, folder)
    inside = occ.join(spans, (occ.contig_id == spans.contig_id) & (F.col("pos") >= F.col("span_start")) & (F.col("pos") + 15 <= F.col("span_end")), "left_semi").groupBy("contig_id").agg(F.count("*").alias("n_shared"))
    return occ.groupBy("contig_id").agg(F.count("*").alias("n_places")).join(inside, "contig_id", "left").select("contig_id", "n_places", F.coalesce("n_shared", F.lit(0)).alias("n_shared"))


_RUNS = """c AS (SELECT DISTINCT contig_id, upper(regexp_replace(seq, '[^A-Za-z]+', '', 'g')) AS s FROM contig WHERE seq IS NOT NULL),
w AS (SELECT contig_id, p, substr(s, p + 1, 120) AS x FROM c, unnest(range(0, length(s) - 119)) AS u(p) WHERE length(s) >= 120),
h AS (SELECT x FROM w GROUP BY x HAVING min(contig_id) <> max(contig_id)),
m AS (SELECT contig_id, p, max(p) OVER (PARTITION BY contig_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q FROM w SEMI JOIN h ON w.x = h.x),
g AS (SELECT contig_id, p, sum(CASE WHEN p <= q + 120 THEN 0 ELSE 1 END) OVER (PARTITION BY contig_id ORDER BY p) AS run FROM m),
found AS (SELECT contig_id, CAST(min(p) AS INTEGER) AS span_start, CAST(max(p) + 120 AS INTEGER) AS span_end FROM g GROUP BY contig_id, run)"""

SQL = {
    "p2_occurrences": f"""WITH {_RUNS}, o AS (SELECT DISTINCT contig_id, pos FROM occ WHERE contig_id IS NOT NULL AND pos IS NOT NULL)
SELECT contig_id, count(*) AS n_places, count(*) FILTER (EXISTS (SELECT 1 FROM found f WHERE f.contig_id = o.contig_id AND pos >= span_start AND pos + 15 <= span_end)) AS n_shared FROM o GROUP BY 1""",
    "p2_found": f"WITH {_RUNS} SELECT * FROM found",
    "p2_shares": f"""WITH {_RUNS}, n AS (SELECT DISTINCT contig_id, CAST(coalesce(length(regexp_replace(seq, '[^A-Za-z]+', '', 'g')), 0) AS INTEGER) AS n_letters FROM contig)
SELECT contig_id, n_letters, CAST(coalesce((SELECT sum(span_end - span_start) FROM found f WHERE f.contig_id = n.contig_id), 0) AS BIGINT) AS n_shared FROM n""",
}
