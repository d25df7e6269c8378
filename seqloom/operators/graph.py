"""Communities of signed graphs, for all parameter points at once.

The objective is the sum over pairs within a community of A+ - gamma k k' / 2m - lambda A-: modularity with a
resolution on the attraction layer less the weight of repulsion. Nodes move to the neighbouring community with the
largest gain; half of them, chosen by a hash that changes, may move in a round and the other half in the next, so that
neighbours do not swap. A round is kept only if the objective grew; if it did not, a smaller share may move in the next,
at last the node with the largest gain alone. When no node gains by moving, communities are contracted and moved again
as one, until a level contracts nothing.

Communities lie within components of the attraction layer, whose moves do not touch each other, so each component goes
its own way: with at most LOCAL_EDGES edges by arrays in one task, and a larger one by joins and aggregations, in the
same rounds.

Defined results: nodes without edges are communities of their own; self edges, null ends and weights <= 0 are no
edges; parallel edges keep the largest weight; results do not depend on the order of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import dropped, written

# fixed values: the parameter points (resolution, repulsion factor) of the default sweep
SWEEP = [(1.0, 1.0), (1.0, 3.0), (1.0, 10.0), (2.0, 3.0), (2.0, 10.0), (2.0, 30.0)]
#: nodes are shared into at most so many turns; then they move one by one
FEWEST = 64
#: edges of a component that one task holds at most
LOCAL_EDGES = 200_000


def minimum_labels(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of each component of links (a, b), by propagation of minima.

    In a round every vertex, and the vertex its label names, takes the smallest label of a label among its neighbours,
    and every vertex takes its label's label. The reach of a label doubles, so long chains take few rounds.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).filter("a is not null and b is not null and a <> b").distinct().toDF("src", "dst"), "adjacent")
    labels = written(both.groupBy(F.col("src").alias("v")).agg(F.least(F.col("v"), F.min("dst")).alias("label")), "labels")
    before = labels
    while True:
        onward = labels.join(labels.toDF("label", "far"), "label").select("v", "label", "far")
        near = both.join(onward.select(F.col("v").alias("dst"), "far"), "dst").groupBy(F.col("src").alias("v")).agg(F.min("far").alias("near"))
        seen = onward.join(near, "v")
        offers = seen.select(F.explode(F.array(F.struct("v", F.least("far", "near").alias("to"), F.col("label").alias("was")), F.struct(F.col("label").alias("v"), F.least("far", "near").alias("to"), F.lit(None).cast(labels.schema["label"].dataType).alias("was")))).alias("o")).select("o.*")
        after = written(offers.groupBy("v").agg(F.min("to").alias("label"), F.min("was").alias("was")), "labels")
        dropped(before)
        before, labels = after, after.select("v", "label")
        if after.filter("label < was").isEmpty():
            dropped(both)
            return labels


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over edges (a, b)."""
    return minimum_labels(edges).toDF("node", "component")


def _canonical(edges: DataFrame) -> DataFrame:
    kept = edges.filter("a is not null and b is not null and a <> b and weight > 0")
    return kept.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("weight").alias("weight"))


def objective(level: DataFrame, degrees: DataFrame, comm: DataFrame) -> DataFrame:
    """(point, q) of a partition (point, node, c): links (point, src, dst, w) inside less the expected ones."""
    inside = level.join(comm.toDF("point", "src", "cs"), ["point", "src"]).join(comm.toDF("point", "dst", "cd"), ["point", "dst"]).filter("cs = cd").groupBy("point").agg(F.sum("w").alias("inside"))
    sums = comm.join(degrees, ["point", "node"]).groupBy("point", "c").agg(F.sum("k").alias("total_k"), F.first("scale").alias("scale")).groupBy("point").agg(F.sum(F.col("scale") * F.col("total_k") * F.col("total_k")).alias("expected"))
    return sums.join(inside, "point", "left").select("point", (F.coalesce("inside", F.lit(0.0)) - F.col("expected")).alias("q"))


def _wishes(level: DataFrame, degrees: DataFrame, comm: DataFrame) -> DataFrame:
    """(point, node, c, to, more): each node's community, its best one, and what it gains by moving there."""
    own = comm.join(degrees, ["point", "node"])
    total = own.groupBy("point", "c").agg(F.sum("k").alias("total_k"))
    links = level.filter("src <> dst").join(comm.toDF("point", "dst", "c"), ["point", "dst"]).groupBy("point", F.col("src").alias("node"), "c").agg(F.sum("w").alias("link"))
    options = links.unionByName(comm.withColumn("link", F.lit(0.0))).groupBy("point", "node", "c").agg(F.sum("link").alias("link"))
    options = options.join(own.select("point", "node", F.col("c").alias("now"), "k", "scale"), ["point", "node"]).join(total, ["point", "c"])
    gain = F.round(F.col("link") - F.col("scale") * F.col("k") * (F.col("total_k") - F.when(F.col("c") == F.col("now"), F.col("k")).otherwise(0.0)), 12)
    options = options.withColumn("gain", gain)
    best = options.groupBy("point", "node").agg(F.first("now").alias("now"), F.max(F.when(F.col("c") == F.col("now"), F.col("gain"))).alias("stay"), F.max("gain").alias("top"), F.min(F.struct((-F.col("gain")).alias("g"), F.col("c").alias("c"))).alias("to"))
    return best.select("point", "node", F.col("now").alias("c"), F.col("to.c").alias("to"), (F.col("top") - F.col("stay")).alias("more"))


def _turns(hashes: Column, turn: int, share: int) -> Column:
    """Whether it is a node's turn; as many rounds in a row as nodes are shared into give every node one."""
    return F.pmod(F.shiftrightunsigned(hashes, 7 * (turn // share) % 57) + turn, F.lit(share)) == 0


def _settled(level: DataFrame, degrees: DataFrame, comm: DataFrame, rounds: int) -> DataFrame:
    """The partition (point, node, c) that comm becomes when no node gains by moving; more rounds are an error."""
    score = {r["point"]: r["q"] for r in objective(level, degrees, comm).collect()}
    share, ended = dict.fromkeys(score, 2), set()
    held = None
    for turn in range(rounds):
        wishes = written(_wishes(level, degrees, comm), "wishes")
        if held is not None:
            dropped(held)
        held = wishes
        comm = wishes.select("point", "node", "c")
        wish = F.col("more") > 1e-9
        first = {r["point"]: r["m"]["node"] for r in wishes.filter(wish).groupBy("point").agg(F.min(F.struct((-F.col("more")).alias("g"), "node")).alias("m")).collect()}
        moving = [p for p in first if p not in ended]
        if not moving:
            return comm
        may = F.lit(False)
        for p in moving:
            turns = _turns(F.xxhash64("node"), turn, share[p]) if share[p] <= FEWEST else F.col("node") == first[p]
            may |= (F.col("point") == p) & turns
        after = wishes.select("point", "node", F.when(may & wish, F.col("to")).otherwise(F.col("c")).alias("c"))
        now = {r["point"]: r["q"] for r in objective(level, degrees, after).collect()}
        better = [p for p in moving if now[p] > score[p] + 1e-9]
        score |= {p: now[p] for p in better}
        ended |= {p for p in moving if p not in better and share[p] > FEWEST}  # a gain below what the sum can show
        share |= {p: max(2, share[p] // 2) if p in better else 2 * share[p] for p in moving}
        comm = wishes.select("point", "node", F.when(F.col("point").isin(better) & may & wish, F.col("to")).otherwise(F.col("c")).alias("c"))
    raise RuntimeError(f"communities still change after {rounds} rounds")


class _Arrays:
    """One component at one parameter point: links (src, dst, w) in both directions, degrees k, and a hash a node; nodes are numbers in the order of their names."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, w: np.ndarray, k: np.ndarray, scale: float, hashes: np.ndarray):
        self.src, self.dst, self.w, self.k, self.scale, self.hashes, self.n = src, dst, w, k, scale, hashes, len(k)

    def objective(self, comm: np.ndarray) -> float:
        total = np.bincount(comm, self.k, self.n)
        return float(self.w[comm[self.src] == comm[self.dst]].sum() - self.scale * (total * total).sum())

    def wishes(self, comm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best community of each node, the smallest of equally good ones, and what the node gains by moving there."""
        apart, own = self.src != self.dst, np.arange(self.n)
        key, at = np.unique(np.concatenate((self.src[apart] * self.n + comm[self.dst[apart]], own * self.n + comm)), return_inverse=True)
        link = np.bincount(at, np.concatenate((self.w[apart], np.zeros(self.n))), len(key))
        node, to = key // self.n, key % self.n
        total = np.bincount(comm, self.k, self.n)
        gain = np.round(link - self.scale * self.k[node] * (total[to] - np.where(to == comm[node], self.k[node], 0.0)), 12)
        stay = np.zeros(self.n)
        stay[node[to == comm[node]]] = gain[to == comm[node]]
        order = np.lexsort((to, -gain, node))
        best = order[np.searchsorted(node[order], own)]
        return to[best], gain[best] - stay

    def settled(self, rounds: int) -> np.ndarray:
        """The partition when no node gains by moving, each node alone at first."""
        comm = np.arange(self.n)
        score, share = self.objective(comm), 2
        for turn in range(rounds):
            to, more = self.wishes(comm)
            wish = more > 1e-9
            if not wish.any():
                return comm
            may = ((self.hashes >> np.uint64(7 * (turn // share) % 57)).view(np.int64) + turn) % share == 0 if share <= FEWEST else np.arange(self.n) == more.argmax()
            after = np.where(may & wish, to, comm)
            now = self.objective(after)
            if now > score + 1e-9:
                comm, score, share = after, now, max(2, share // 2)
            elif share > FEWEST:
                return comm  # a gain below what the sum can show
            else:
                share *= 2
        raise RuntimeError(f"communities still change after {rounds} rounds")

    def communities(self, rounds: int) -> np.ndarray:
        """The community of each node after all levels."""
        level, membership = self, np.arange(self.n)
        while True:
            comm = level.settled(rounds)
            named, place = np.unique(comm, return_inverse=True)
            membership = place[membership]
            if len(named) == level.n:
                return membership
            key, at = np.unique(place[level.src] * len(named) + place[level.dst], return_inverse=True)
            level = _Arrays(key // len(named), key % len(named), np.bincount(at, level.w, len(key)), np.bincount(place, level.k, len(named)), level.scale, level.hashes[named])


def _within(points: list[tuple[float, float]], two_m: float, rounds: int):
    """Communities of one component from its edges (a, b, ha, hb, attract, repel); the hashes are those of the ends."""

    def run(edges: pa.Table) -> pa.Table:
        ends = [np.array(edges.column(c).to_pylist(), object) for c in "ab"]
        names, number = np.unique(np.concatenate(ends), return_inverse=True)
        hashes = np.zeros(len(names), np.int64)
        hashes[number] = np.concatenate([edges.column(c).to_numpy() for c in ("ha", "hb")])
        a, b = number[: len(edges)], number[len(edges) :]
        attract, repel = (edges.column(c).to_numpy() for c in ("attract", "repel"))
        k = np.bincount(np.concatenate((a, b)), np.tile(attract, 2), len(names))
        parts = []
        for i, (gamma, factor) in enumerate(points):
            w = attract - factor * repel
            arrays = _Arrays(np.concatenate((a, b)), np.concatenate((b, a)), np.tile(w, 2), k, gamma / two_m, hashes.view(np.uint64))
            found = arrays.communities(rounds)
            least = np.full(len(names), len(names))
            np.minimum.at(least, found, np.arange(len(names)))
            parts.append(pa.table({"point": pa.array(np.full(len(names), i), pa.int32()), "node": pa.array(names.tolist(), pa.string()), "community": pa.array(names[least[found]].tolist(), pa.string())}))
        return pa.concat_tables(parts)

    return run


def communities(nodes: DataFrame, attraction: DataFrame, repulsion: DataFrame | None = None, points: list[tuple[float, float]] | None = None, rounds: int = 1000, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(point, node, community) for each parameter point (resolution, factor); community is named by its smallest node.

    nodes (node string), attraction and repulsion (a, b, weight). Without points, one with resolution 1. Nodes that edges
    name and nodes lacks are no nodes of the result.
    """
    points = points or [(1.0, 0.0)]
    spark = nodes.sparkSession
    pos, names = written(_canonical(attraction), "attraction"), nodes.select("node").filter("node is not null").distinct()
    two_m = (pos.agg(F.sum("weight")).first()[0] or 0.0) * 2
    signed = pos.select("a", "b", F.col("weight").alias("attract"), F.lit(0.0).alias("repel"))
    if repulsion is not None:
        signed = signed.unionByName(_canonical(repulsion).select("a", "b", F.lit(0.0).alias("attract"), F.col("weight").alias("repel")))
    signed = signed.groupBy("a", "b").agg(F.sum("attract").alias("attract"), F.sum("repel").alias("repel"))
    inside = components(pos)
    # repulsion between components keeps nothing apart that could come together
    edges = signed.join(inside.toDF("a", "component"), "a").join(inside.toDF("b", "component"), ["b", "component"])
    edges = written(edges.withColumn("ha", F.xxhash64("a")).withColumn("hb", F.xxhash64("b")), "edges")
    large = [r["component"] for r in edges.groupBy("component").count().filter(F.col("count") > local_edges).orderBy("component").collect()]  # at most all edges over local_edges
    schema = "point int, node string, community string"
    columns = ("component", "a", "b", "ha", "hb", "attract", "repel")
    small = edges.join(spark.createDataFrame([(c,) for c in large], "component string"), "component", "left_anti") if large else edges
    placed = small.select(*columns).groupBy("component").applyInArrow(_within(points, two_m or 1.0, rounds), schema)
    if large:
        numbers = spark.createDataFrame(list(enumerate(large)), "nth int, component string")
        placed = placed.unionByName(_spread_communities(edges.join(numbers, "component"), points, two_m or 1.0, rounds))
    everywhere = names.select("node", F.explode(F.array(*(F.lit(i) for i in range(len(points))))).alias("point"))
    return everywhere.join(placed, ["point", "node"], "left").select("point", "node", F.coalesce("community", "node").alias("community"))


def _spread_communities(edges: DataFrame, points: list[tuple[float, float]], two_m: float, rounds: int) -> DataFrame:
    """(point, node, community) of the edges (nth, a, b, attract, repel) of large components, which nth numbers; a component at a parameter point is a point of its own here."""
    n = len(points)
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(g) / two_m).alias("scale"), F.lit(float(f)).alias("factor")) for i, (g, f) in enumerate(points))))
    rows = edges.withColumn("p", each).select((F.col("nth") * n + F.col("p.i")).alias("point"), "a", "b", "attract", (F.col("attract") - F.col("p.factor") * F.col("repel")).alias("w"), "p.scale")
    level = written(rows.select("point", F.col("a").alias("src"), F.col("b").alias("dst"), "w").unionByName(rows.select("point", F.col("b").alias("src"), F.col("a").alias("dst"), "w")), "level")
    degrees = written(rows.select("point", F.explode(F.array("a", "b")).alias("node"), "attract", "scale").groupBy("point", "node").agg(F.sum("attract").alias("k"), F.first("scale").alias("scale")), "degrees")
    membership = degrees.select("point", "node", F.col("node").alias("c"))
    inner, size = membership, degrees.count()
    while True:
        current = written(_settled(level, degrees, inner, rounds), "partition")
        membership = written(membership.join(current.toDF("point", "c", "c2"), ["point", "c"]).select("point", "node", F.col("c2").alias("c")), "membership")
        # contract: communities become nodes, links between and within them add up
        source, target = current.toDF("point", "src", "cs"), current.toDF("point", "dst", "cd")
        level = written(level.join(source, ["point", "src"]).join(target, ["point", "dst"]).groupBy("point", F.col("cs").alias("src"), F.col("cd").alias("dst")).agg(F.sum("w").alias("w")), "level")
        degrees = written(degrees.join(current, ["point", "node"]).groupBy("point", F.col("c").alias("node")).agg(F.sum("k").alias("k"), F.first("scale").alias("scale")), "degrees")
        inner, before, size = degrees.select("point", "node", F.col("node").alias("c")), size, degrees.count()
        if size == before:
            break
    first = membership.groupBy("point", "c").agg(F.min("node").alias("community"))
    return membership.join(first, ["point", "c"]).select(F.pmod("point", F.lit(n)).cast("int").alias("point"), "node", "community")


def violated(membership: DataFrame, repulsion: DataFrame) -> DataFrame:
    """(point, n): repulsion edges with both ends in one community."""
    ends = repulsion.join(membership.toDF("point", "a", "ca"), "a").join(membership.toDF("point", "b", "cb"), ["point", "b"]).filter("ca = cb")
    return ends.groupBy("point").agg(F.count("*").alias("n"))
