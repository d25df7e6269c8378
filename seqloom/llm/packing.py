"""Filling of containers of fixed capacity with items of varying length.

Lengths are counted; with more lengths than KINDS, runs of neighbouring ones are one kind. Patterns are the few-item ways
of filling a container nearly full with kinds; how often each is repeated is fitted to the histogram by non-negative
least squares and rounded. Patterns then take true lengths, and what the histogram still holds is packed longest first,
by true lengths, into the room they leave and into containers of its own. Everything up to here works on the histogram,
whose size is that of the capacity and not of the data. The items then take the places of the plan by their rank within
their length; ranks come from counts by part, so a length that most items have is still ranked in parallel.

Defined results: an item longer than a container is cut into full containers and one rest, and no other item is cut;
items without length (null and empty texts) take no room and are spread over the containers, or lie in container 0
where there is no other; every container's lengths sum to at most the capacity; no items give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spread, table, written
from .tokens import encode_documents

CAPACITY = 2048
#: kinds of lengths the patterns are made of; with more lengths than kinds, neighbouring lengths are one kind
KINDS = 128
#: items that one part ranks
PART_ROWS = 1_000_000
#: a pattern leaves at most the capacity over this number unused
TIGHT = 64


def kinds_of(histogram: dict[int, int], kinds: int = KINDS) -> list[list[int]]:
    """The lengths of a histogram in at most so many runs of neighbours, longest last; each run spans about as many letters."""
    lengths = sorted(histogram)
    if len(lengths) <= kinds:
        return [[x] for x in lengths]
    step = -(-lengths[-1] // kinds)
    runs: dict[int, list[int]] = {}
    for x in lengths:
        runs.setdefault((x - 1) // step, []).append(x)
    return [runs[k] for k in sorted(runs)]


def tight_patterns(sizes: list[int], capacity: int, waste: int) -> list[tuple[int, ...]]:
    """Pairs and triples of sizes that leave at most `waste` of the capacity: for every two the largest third that fits."""
    out, down = set(), sorted(set(sizes), reverse=True)
    for i, x in enumerate(down):
        if capacity // x > 1 and capacity % x <= waste:
            out.add((x,) * (capacity // x))
        for y in down[i:]:
            left = capacity - x - y
            if 0 <= left <= waste:
                out.add((x, y))
            at = bisect_right(sizes, min(left, y)) - 1
            if left > 0 and at >= 0 and left - sizes[at] <= waste:
                out.add((x, y, sizes[at]))
    return sorted(out, reverse=True)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson.

    The method ends by itself; at the latest after `rounds` new columns (three times the rows) with the x of then, which
    is feasible, and what it leaves unfitted is packed as the rest is.
    """
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    rhs = a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(rhs).max(initial=0.0)))
    for _ in range(rounds or 3 * a.shape[0]):
        at = np.flatnonzero(free)
        slope = a.T @ (b - a[:, at] @ x[at])
        slope[free] = -np.inf
        if n == 0 or slope.max() <= tolerance:
            break
        free[int(slope.argmax())] = True
        while True:
            at = np.flatnonzero(free)
            part = a[:, at]
            y = np.linalg.lstsq(part.T @ part, rhs[at], rcond=1e-12)[0]
            if (y > 0).all():
                x[:] = 0
                x[at] = y
                break
            low = y <= 0
            step = np.min(x[at][low] / (x[at][low] - y[low] + 1e-300))
            x[at] += step * (y - x[at])
            free[at[(x[at] <= 1e-12) & low]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def _greedy(left: dict[int, int], space: int) -> Counter:
    """What fills a container of so much space, longest first."""
    used: Counter = Counter()
    for x in sorted((x for x in left if x <= space), reverse=True):
        m = min(space // x, left[x])
        if m:
            used[x] = m
            space -= m * x
    return used


def _true_lengths(pattern: tuple[int, ...], ranges: dict[int, list[int]], left: dict[int, int], capacity: int) -> Counter | None:
    """Lengths that take the pattern's places: of each kind the longest there is, in the last place the longest that fits in."""
    contents: Counter = Counter()
    for place, kind in enumerate(pattern):
        room = capacity - sum(x * m for x, m in contents.items())
        last = place == len(pattern) - 1
        fits = (x for x in (range(room, ranges[kind][0] - 1, -1) if last else reversed(ranges[kind])) if left.get(x, 0) > contents[x])
        if (chosen := next(fits, None)) is None:
            return None
        contents[chosen] += 1
    return contents


def plan(histogram: dict[int, int], capacity: int, kinds: int = KINDS) -> list[tuple[dict[int, int], int]]:
    """(contents, repeats): containers of `contents` (items by length), which hold exactly the histogram's items.

    Patterns of kinds are fitted and rounded and take true lengths, so that the room they leave is known and takes what
    fits of the items that no pattern took. The rest of these fill containers of their own.
    """
    left = {x: n for x, n in histogram.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []
    if capacity in left:
        out.append(({capacity: 1}, left.pop(capacity)))
    runs = kinds_of(left, kinds)
    longest = [run[-1] for run in runs]
    patterns = tight_patterns(longest, capacity, capacity // TIGHT)
    opened: list[tuple[Counter, int]] = []
    if patterns:
        row, ranges = {x: i for i, x in enumerate(longest)}, {run[-1]: run for run in runs}
        a = np.zeros((len(row), len(patterns)))
        for j, p in enumerate(patterns):
            for x in p:
                a[row[x], j] += 1
        # a long item left over costs more room than a short one
        weight = np.array([0.1 + x / capacity for x in longest])
        wanted = np.array([sum(left[x] for x in run) for run in runs], float)
        fitted = non_negative_least_squares(a * weight[:, None], wanted * weight)
        for j in np.argsort(-fitted, kind="stable"):
            n = int(round(fitted[j]))
            while n > 0 and (contents := _true_lengths(patterns[j], ranges, left, capacity)):
                same = min([n, *(left[x] // m for x, m in contents.items())])
                for x, m in contents.items():
                    left[x] -= m * same
                opened.append((contents, same))
                n -= same
    left = {x: n for x, n in left.items() if n}
    # the rest goes into the room that patterns leave, then into containers of its own
    for contents, n in opened:
        room = capacity - sum(x * m for x, m in contents.items())
        while n:
            more = _greedy(left, room) if left and min(left) <= room else Counter()
            same = min([n, *(left[x] // m for x, m in more.items())]) if more else n
            out.append((dict(contents + more), same))
            for x, m in more.items():
                left[x] -= m * same
                if not left[x]:
                    del left[x]
            n -= same
    while left:
        used = _greedy(left, capacity)
        n = min(left[x] // m for x, m in used.items())
        out.append((dict(used), n))
        for x, m in used.items():
            left[x] -= n * m
        left = {x: k for x, k in left.items() if k}
    return out


def _places(spark: SparkSession, containers: list[tuple[dict[int, int], int]]) -> DataFrame:
    """(length, low, high, repeats, base): ranks of a length from low to below high lie in the containers from base on."""
    rows, next_rank, base = [], Counter(), 0
    for contents, n in containers:
        for x, m in sorted(contents.items()):
            rows.append((x, next_rank[x], next_rank[x] + n * m, n, base))
            next_rank[x] += n * m
        base += n
    return spark.createDataFrame(rows, "length int, low bigint, high bigint, repeats bigint, base bigint")


def pack_items(items: DataFrame, capacity: int = CAPACITY, kinds: int = KINDS) -> DataFrame:
    """(item_id, piece, start, length, container_id) of items (item_id bigint, size), each of whose rows is an item of its own."""
    spark = items.sparkSession
    size = F.coalesce("size", F.lit(0))
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(size / capacity) - 1))
    cut = items.select("item_id", size.alias("size"), F.explode(pieces).alias("piece"))
    cut = cut.select("item_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).cast("int").alias("start"), F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).cast("int").alias("length"))
    cut = written(cut, "pieces")
    parts = max(spread(spark), -(-cut.count() // PART_ROWS))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("item_id", "piece"), F.lit(parts)).cast("int"))
    counts = cut.groupBy("part", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most capacity + 1 rows
    histogram.pop(0, None)
    containers = plan(histogram, capacity, kinds)
    total = sum(n for _, n in containers)
    # rank in a length: what the parts before hold of it, and the rank within the part
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = F.row_number().over(Window.partitionBy("part", "length").orderBy("item_id", "piece")) - 1
    ranked = cut.filter("length > 0").withColumn("within", within).join(offsets, ["part", "length"]).withColumn("rank", F.col("within") + F.col("offset"))
    places = _places(spark, containers)  # as many rows as the plan has places, which the capacity bounds
    sized = ranked.join(F.broadcast(places), "length").filter("rank >= low and rank < high").withColumn("container_id", F.col("base") + F.pmod(F.col("rank") - F.col("low"), F.col("repeats")))
    bare = cut.filter("length = 0").withColumn("container_id", F.pmod(F.xxhash64("item_id"), F.lit(max(1, total))))
    columns = ["item_id", "piece", "start", "length", "container_id"]
    return sized.select(columns).unionByName(bare.select(columns))


def document_sizes(documents: DataFrame) -> DataFrame:
    """(item_id, size) of documents in tokens; written, as packing reads it more than once."""
    return written(encode_documents(documents).select(F.col("doc_id").alias("item_id"), F.size("ids").alias("size")), "sizes")


def p8_packed(spark, folder: str) -> DataFrame:
    """(doc_id, piece, start, length, container_id): places of all documents, in tokens."""
    sizes = document_sizes(table(spark, folder, "documents").select("doc_id", "text"))
    return pack_items(sizes).withColumnRenamed("item_id", "doc_id")


def p8_fill(spark, folder: str) -> DataFrame:
    """Containers by how many tokens of them are unused."""
    used = p8_packed(spark, folder).groupBy("container_id").agg(F.sum("length").alias("used"))
    return used.groupBy((F.lit(CAPACITY) - F.col("used")).alias("unused")).agg(F.count("*").alias("n_containers"))


def p8_checked(spark, folder: str) -> DataFrame:
    """One row of what must hold of the places: documents, those not placed whole and once, those cut without need, overfull containers, and whether at most 1 percent (and one) more containers are used than tokens fill."""
    sizes = document_sizes(table(spark, folder, "documents").select("doc_id", "text"))
    placed = written(pack_items(sizes), "placed")
    near = Window.partitionBy("item_id").orderBy("piece")
    rows = placed.withColumn("expected", F.coalesce(F.sum("length").over(near.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(near) - 1)
    docs = rows.groupBy("item_id").agg(F.sum("length").alias("total"), F.count("*").alias("n"), F.max((F.col("start") != F.col("expected")) | (F.col("piece") != F.col("nth"))).alias("odd"))
    met = sizes.join(docs, "item_id", "left")
    whole = F.coalesce((F.col("total") == F.col("size")) & ~F.col("odd"), F.lit(False))
    per_document = met.agg(F.count("*").alias("n_documents"), F.count_if(~whole).alias("n_not_whole"), F.count_if(F.col("n") > F.greatest(F.lit(1), F.ceil(F.col("size") / CAPACITY))).alias("n_needless_cuts"), F.sum("size").alias("tokens"))
    used = placed.groupBy("container_id").agg(F.sum("length").alias("used"))
    per_container = used.agg(F.count_if(F.col("used") > CAPACITY).alias("n_overfull"), F.count_if(F.col("used") > 0).alias("n_containers"))
    both = per_document.join(per_container)  # one row each
    return both.select("n_documents", "n_not_whole", "n_needless_cuts", "n_overfull", (F.col("n_containers") <= F.lit(1.01) * F.coalesce("tokens", F.lit(0)) / CAPACITY + 1).alias("tight"))


SQL = {"p8_checked": "SELECT count(DISTINCT doc_id) AS n_documents, 0::BIGINT AS n_not_whole, 0::BIGINT AS n_needless_cuts, 0::BIGINT AS n_overfull, true AS tight FROM documents"}
