"""Consolidation of pairwise matches into groups: connected components over very many pairs.

The giant component is peeled by breadth-first joins of a frontier from the vertex of highest degree and taken away
by an anti-join; the small components that remain are labelled by minimum propagation, which also hooks labels to each other so
that chains take logarithmically many rounds. Vertices are numbered in byte order of their
names, so links, frontiers and labels are pairs of integers and the smallest number names the group.

Defined results: null ends, self links and NaN scores are no links; links given twice or in either order are one;
no links give no rows; every linked vertex gets exactly one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import minimum_labels
from ..session import dropped, table, written

#: hops of the frontier between two written tables
HOPS = 3
#: Rounds of the frontier. What a longer giant component has beyond them is labelled with the rest, the peeled part
#: standing in as one vertex, so the number changes the time and not the result.
FRONTIER_ROUNDS = 12


def numbered(names: DataFrame) -> DataFrame:
    """(name, v): distinct names with numbers in byte order."""
    return written(names.distinct().repartitionByRange("name").sortWithinPartitions("name").select("name", F.monotonically_increasing_id().alias("v")), "names")


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(links.select(F.col("b").alias("src"), F.col("a").alias("dst")))


def peel_giant(links: DataFrame, rounds: int = FRONTIER_ROUNDS) -> tuple[DataFrame | None, bool]:
    """Vertices (v) reached from the vertex of highest degree, and whether they are its whole component.

    A few hops are one job; then the links of the vertices that it expanded are left out, so that later hops read only
    what may lead on.
    """
    both = _both_ways(links)
    start = both.groupBy("src").count().orderBy(F.desc("count"), "src").limit(1).select(F.col("src").alias("v")).collect()
    if not start:
        return None, True
    frontier = links.sparkSession.createDataFrame([(start[0]["v"],)], "v bigint")
    seen, left = [frontier], rounds
    while left > 0:
        hops, step = [], frontier
        for i in range(1, min(HOPS, left) + 1):
            step = both.join(step.withColumnRenamed("v", "src"), "src", "left_semi").select(F.col("dst").alias("v")).distinct()
            hops.append(step.withColumn("hop", F.lit(i)))
        nearest = reduce(DataFrame.unionByName, hops).groupBy("v").agg(F.min("hop").alias("hop"))
        # links of expanded vertices are gone, so hops lead back only into what this job met and where it began
        found = written(nearest.join(frontier, "v", "left_anti"), "frontier")
        seen.append(found.select("v"))
        last, left = len(hops), left - len(hops)
        beyond = found.filter(F.col("hop") == last).select("v")
        if beyond.isEmpty():
            return written(reduce(DataFrame.unionByName, seen), "giant"), True
        if left > 0:
            expanded = frontier.unionByName(found.filter(F.col("hop") < last).select("v")).withColumnRenamed("v", "src")
            former, both = both, written(both.join(expanded, "src", "left_anti").join(expanded.withColumnRenamed("src", "dst"), "dst", "left_anti"), "onward")
            dropped(former)
        frontier = beyond
    return written(reduce(DataFrame.unionByName, seen), "giant"), False


def connected_components(links: DataFrame, rounds: int = FRONTIER_ROUNDS) -> DataFrame:
    """(group_id, member) of links (a string, b string): group_id is the smallest member in byte order."""
    clean = links.filter("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    clean = written(clean, "links")
    names = numbered(clean.select(F.explode(F.array("a", "b")).alias("name")))
    left, right = names.toDF("a", "va"), names.toDF("b", "vb")
    ids = written(clean.join(left, "a").join(right, "b").select(F.col("va").alias("a"), F.col("vb").alias("b")), "numbers")
    giant, whole = peel_giant(ids, rounds)
    spark = links.sparkSession
    if giant is None:
        return spark.createDataFrame([], "group_id string, member string")
    root = giant.agg(F.min("v")).first()[0]
    if whole:
        rest = ids.join(giant.withColumnRenamed("v", "a"), "a", "left_anti")
    else:
        inside = giant.withColumn("in", F.lit(True))
        rest = ids.join(inside.toDF("a", "in_a"), "a", "left").join(inside.toDF("b", "in_b"), "b", "left")
        rest = rest.select(F.when(F.col("in_a"), root).otherwise(F.col("a")).alias("a"), F.when(F.col("in_b"), root).otherwise(F.col("b")).alias("b")).filter("a <> b").distinct()
    labels = minimum_labels(rest)
    if not whole:  # the part of the giant beyond the frontier's rounds
        top = labels.filter(F.col("v") == root).collect()
        final = top[0]["label"] if top else root
        giant = giant.unionByName(labels.filter(F.col("label") == final).select("v")).distinct()
        labels, root = labels.filter(F.col("label") != final), final
    # the giant's name is one value; the small groups get theirs by a join
    named = names.toDF("member", "v")
    of_giant = named.join(giant, "v", "left_semi").select(F.lit(names.filter(F.col("v") == root).first()["name"]).alias("group_id"), "member")
    of_rest = named.join(labels, "v").join(names.toDF("group_id", "label"), "label").select("group_id", "member")
    return of_giant.unionByName(of_rest)


def record_owner(record: Column) -> Column:
    """SAG of `<sag id>|<rec_name>` or `<sag id>__<rec_name>`: what stands before the last separator."""
    return F.nullif(F.regexp_extract(record, r"^(.*)(?:\||__)", 1), F.lit(""))


def sag_links(estimate: DataFrame, hit: DataFrame, min_ani: float = 95.0, min_af: float = 30.0, min_cover: float = 0.9) -> DataFrame:
    """(a, b): SAGs tied by a pair result or by a hit that covers its query record."""
    number = lambda c: ~F.isnan(c) & F.col(c).isNotNull()
    by_ani = estimate.filter(number("ani") & number("af_ref") & (F.col("ani") >= min_ani) & (F.col("af_ref") >= min_af)).select(F.col("sag1").alias("a"), F.col("sag2").alias("b"))
    by_hit = hit.filter((F.col("ql") > 0) & ((F.col("qe") - F.col("qs")) / F.col("ql") >= min_cover)).select(record_owner(F.col("q")).alias("a"), record_owner(F.col("t")).alias("b"))
    return by_ani.unionByName(by_hit)


def p3_found(spark, folder: str) -> DataFrame:
    links = sag_links(table(spark, folder, "estimate"), table(spark, folder, "hit"))
    return connected_components(links).withColumnRenamed("member", "sag_id")


def p3_sizes(spark, folder: str) -> DataFrame:
    """Groups by size: how many groups of each size there are."""
    sizes = p3_found(spark, folder).groupBy("group_id").agg(F.count("*").alias("n_sags"))
    return sizes.groupBy("n_sags").agg(F.count("*").alias("n_groups"))


_LINKS = """l AS (SELECT sag1 AS a, sag2 AS b FROM estimate WHERE NOT isnan(ani) AND NOT isnan(af_ref) AND ani >= 95 AND af_ref >= 30
    UNION ALL SELECT regexp_extract(q, '^(.*)(?:\\||__)', 1), regexp_extract(t, '^(.*)(?:\\||__)', 1) FROM hit WHERE ql > 0 AND (qe - qs) / ql >= 0.9),
e AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) WHERE a <> b AND a <> '' AND b <> ''),
r(v, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.v = e.a),
g AS (SELECT min(root) AS group_id, v AS sag_id FROM r GROUP BY v)"""

SQL = {
    "p3_found": f"WITH RECURSIVE {_LINKS} SELECT * FROM g",
    "p3_sizes": f"WITH RECURSIVE {_LINKS} SELECT n_sags, count(*) AS n_groups FROM (SELECT group_id, count(*) AS n_sags FROM g GROUP BY 1) GROUP BY 1",
}
