"""Pairs of similar entities: candidates by shared sketch hashes, and exact set-similarity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .search import posting_index

#: entities of a frequent hash that one group holds where all pairs are asked for
GROUP = 1000


def shared_counts(index: DataFrame) -> DataFrame:
    """(a, b, shared) for a < b over an index (hash, entity)."""
    left, right = index.toDF("hash", "a"), index.toDF("hash", "b")
    return left.join(right, "hash").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def all_candidates(sketches: DataFrame, min_shared: int = 1, group: int = GROUP) -> DataFrame:
    """(a, b, shared): all pairs of entities that share min_shared hashes or more, however many entities hold a hash.

    The entities of a hash that more than `group` hold are dealt into groups of about that size, and every group meets
    every group as a key of its own, so no task has all pairs of a hash.
    """
    sketches = written(sketches, "sketches")
    held = written(sketches.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > group).select("hash", F.ceil(F.col("n") / group).alias("parts")), "frequent")
    rare = sketches.select("hash", "entity").join(held, "hash", "left_anti")
    dealt = sketches.select("hash", "entity").join(held, "hash").withColumn("own", F.pmod(F.xxhash64("entity"), "parts")).withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    left = dealt.select("hash", F.col("own").alias("g"), F.col("met").alias("h"), F.col("entity").alias("a"))
    right = dealt.select("hash", F.col("met").alias("g"), F.col("own").alias("h"), F.col("entity").alias("b"))
    met = left.join(right, ["hash", "g", "h"]).filter("a < b").select("a", "b")
    met = met.unionByName(rare.toDF("hash", "a").join(rare.toDF("hash", "b"), "hash").filter("a < b").select("a", "b"))
    return met.groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= min_shared)


def shared_of(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b, shared) of given pairs (a, b), once each, that share a hash: as all_candidates has it, without other pairs."""
    sketches = written(sketches, "sketches")
    ours = pairs.select("a", "b").distinct().join(sketches.toDF("a", "hash"), "a")
    return ours.join(sketches.toDF("b", "hash"), ["b", "hash"]).groupBy("a", "b").agg(F.count("*").alias("shared"))


def triangle_candidates(sketches: DataFrame, min_shared: int = 1, keep: int = 128, max_posting: int = 1000) -> DataFrame:
    """(a, b, shared, by_a, by_b): pairs that either end has among its keep best, and which of them has.

    A node's partners are ranked by shared hashes, then by id. Hashes of more than max_posting entities do not count,
    as candidate search is defined; the exact join below knows no such limit. keep 0 keeps all.
    """
    index = written(posting_index(written(sketches, "sketches"), max_posting), "index")
    pairs = shared_counts(index).filter(F.col("shared") >= min_shared)
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "shared").unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"), "shared"))
    if keep:
        both = both.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("shared"), "other"))).filter(F.col("r") <= keep)
    picks = both.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "shared", (F.col("node") < F.col("other")).alias("low"))
    return picks.groupBy("a", "b").agg(F.max("shared").alias("shared"), F.max("low").alias("by_a"), F.max(~F.col("low")).alias("by_b"))


def sketch_classes(sketches: DataFrame) -> DataFrame:
    """(entity, class_id, size): entities with equal sketches are one class, named by its smallest entity.

    A sketch is digested without gathering: entities with the same number, sum and product-free mix of hashes are equal
    but for a chance of 2^-64 a pair.
    """
    digest = sketches.groupBy("entity").agg(F.count("*").alias("size"), F.sum(F.xxhash64("hash").cast("decimal(20,0)")).alias("mark"), F.bit_xor(F.xxhash64("hash", F.lit(7))).alias("mark2"))
    names = digest.groupBy("size", "mark", "mark2").agg(F.min("entity").alias("class_id"))
    return digest.join(names, ["size", "mark", "mark2"]).select("entity", "class_id", "size")


def similar_classes(sketches: DataFrame, at_least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes (entity, class_id, size) and pairs (a, b, shared, jaccard) of classes with Jaccard at_least or more; exact.

    Prefix filtering: in an order from rare to frequent hashes, two similar sets share one of their first
    size - ceil(at_least * size) + 1. Only these are joined, so a frequent hash makes no pairs unless a set has nothing
    rarer; the candidates are then counted on the whole sets. Entities without hashes are in no class.
    """
    sketches = written(sketches.select("entity", "hash"), "sketches")
    classes = written(sketch_classes(sketches), "classes")
    reps = classes.filter("entity = class_id").select("entity", "size")
    rows = sketches.join(reps, "entity")
    ranked = rows.join(rows.groupBy("hash").agg(F.count("*").alias("held")), "hash")
    order = Window.partitionBy("entity").orderBy("held", "hash")
    ranked = ranked.withColumn("r", F.row_number().over(order))
    prefix = written(ranked.filter(F.col("r") <= F.col("size") - F.ceil(F.col("size") * at_least - 1e-9) + 1).select("hash", "entity", "size"), "prefix")
    left, right = prefix.toDF("hash", "a", "size_a"), prefix.toDF("hash", "b", "size_b")
    near = (F.col("a") < F.col("b")) & (F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * at_least - 1e-9)
    pairs = left.join(right, "hash").filter(near).select("a", "b", "size_a", "size_b").distinct()
    # shared hashes are counted where a candidate's sets meet: its rows, not both sets, move
    pairs = written(pairs, "candidates")
    ours = pairs.join(sketches.toDF("a", "hash"), "a").select("a", "b", "hash")
    shared = ours.join(sketches.toDF("b", "hash"), ["b", "hash"]).groupBy("a", "b").agg(F.count("*").alias("shared"))
    met = pairs.join(shared, ["a", "b"])
    scored = met.withColumn("jaccard", F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared")))
    return classes, scored.filter(F.col("jaccard") >= at_least).select("a", "b", "shared", "jaccard")
