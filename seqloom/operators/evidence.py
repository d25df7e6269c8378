"""Evidence on pairs of entities: best rows a group, edges of attraction and repulsion, purity and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seqfuncs as fn
from .audit import global_rank


def best_row(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each group in an order, which should be total; ranking is limited before the shuffle."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def pair_estimates(estimate: DataFrame) -> DataFrame:
    """(a, b, ani, af_ref, af_query, at) with a < b and valid numbers; self pairs, nulls and NaN are left out."""
    good = None
    for c in ("ani", "af_ref", "af_query"):
        ok = F.col(c).isNotNull() & ~F.isnan(c)
        good = ok if good is None else good & ok
    pairs = estimate.filter("sag1 is not null and sag2 is not null and sag1 <> sag2").filter(good)
    return pairs.select(F.least("sag1", "sag2").alias("a"), F.greatest("sag1", "sag2").alias("b"), "ani", "af_ref", "af_query", F.col("estimated_at").alias("at")).distinct()


def entity_gc(sag: DataFrame) -> DataFrame:
    """(entity, gc): GC percent of the latest registration that has the numbers."""
    known = sag.filter("id is not null and assembly_gc is not null and assembly_acgt > 0").select(F.col("id").alias("entity"), "registered_at", (F.lit(100.0) * F.col("assembly_gc") / F.col("assembly_acgt")).alias("gc"))
    return known.groupBy("entity").agg(F.max(F.struct("registered_at", "gc")).alias("m")).select("entity", "m.gc")


def attraction_edges(pairs: DataFrame, gc: DataFrame, min_ani: float = 95.0, max_gc_gap: float = 2.0) -> DataFrame:
    """(a, b, ani, gc_gap, weight): the heaviest result of each pair close enough in identity and GC."""
    edges = pairs.filter(F.col("ani") >= min_ani).join(gc.toDF("a", "gc_a"), "a").join(gc.toDF("b", "gc_b"), "b")
    edges = edges.withColumn("gc_gap", F.abs(F.col("gc_a") - F.col("gc_b"))).filter(F.col("gc_gap") <= max_gc_gap)
    edges = edges.withColumn("weight", fn.attraction_weight(F.col("ani"), F.col("af_ref"), F.col("af_query")))
    return edges.groupBy("a", "b").agg(F.max(F.struct("weight", "ani", "gc_gap")).alias("m")).select("a", "b", "m.ani", "m.gc_gap", "m.weight")


def pair_evidence(pairs: DataFrame) -> DataFrame:
    """(a, b, n_markers, mean_pident, min_pident): identities of a pair over its results, rounded to three places."""
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n_markers"), F.round(F.avg("ani"), 3).alias("mean_pident"), F.round(F.min("ani"), 3).alias("min_pident"))


def repulsion_edges(evidence: DataFrame, min_markers: int = 3, below: float = 97.0) -> DataFrame:
    kept = evidence.filter((F.col("n_markers") >= min_markers) & (F.col("mean_pident") < below))
    return kept.select("a", "b", "n_markers", "mean_pident", fn.repulsion_weight(F.col("mean_pident")).alias("weight"))


def cluster_purity(membership: DataFrame, pairs: DataFrame, pure_from: float = 97.0, least: int = 10) -> DataFrame:
    """(cluster, size, ok, bad, purity, min_ani) of clusters (cluster, entity) with at least `least` members.

    Pairs count where both ends are in the cluster; purity, rounded half to even, is null without any.
    """
    sizes = membership.groupBy("cluster").agg(F.count("*").alias("size")).filter(F.col("size") >= least)
    inside = pairs.join(membership.select("cluster", F.col("entity").alias("a")), "a").join(membership.select("cluster", F.col("entity").alias("b")), ["b", "cluster"])
    scored = inside.groupBy("cluster").agg(F.count_if(F.col("ani") >= pure_from).alias("ok"), F.count_if(F.col("ani") < pure_from).alias("bad"), F.min("ani").alias("min_ani"))
    out = sizes.join(scored, "cluster", "left").fillna(0, ["ok", "bad"])
    return out.select("cluster", "size", "ok", "bad", F.when(F.col("ok") + F.col("bad") > 0, F.bround(F.col("ok") / (F.col("ok") + F.col("bad")), 3)).alias("purity"), "min_ani")


def select_parameters(scores: DataFrame) -> DataFrame:
    """The row (ord, n_pure, n_members) with most pure clusters, then most members, then the earliest."""
    return scores.agg(F.max(F.struct("n_pure", "n_members", (-F.col("ord")).alias("o"))).alias("m")).select((-F.col("m.o")).alias("ord"), "m.n_pure", "m.n_members")


def name_clusters(membership: DataFrame, least: int = 10) -> DataFrame:
    """(name, entity, cluster_size): clusters of `least` members or more as G0001.. by size, then first member.

    A cluster's first member is its smallest, which orders clusters of equal size as their sorted members would.
    """
    sizes = membership.groupBy("cluster").agg(F.count("*").alias("cluster_size"), F.min("entity").alias("first")).filter(F.col("cluster_size") >= least)
    ranked = global_rank(sizes, F.desc("cluster_size"), F.asc("first"))
    named = ranked.select("cluster", F.format_string("G%04d", F.col("rank") + 1).alias("name"), "cluster_size")
    return membership.join(named, "cluster").select("name", "entity", "cluster_size")
