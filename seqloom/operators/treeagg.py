"""Per-key results where a few keys hold most rows: aggregation as a tree.

Rows are combined within fixed-size chunks of the input where they lie, so a shuffle carries one state a key and
chunk; the states of a key then merge in rounds of a bounded fan-in. No task ever receives all rows or all partial
states of a key, and the number of rounds is logarithmic in the number of chunks.

Defined results: null is a key of its own (the caller drops it if it is none); null values do not enter sum, min,
max or distinct; a key with null values only has sum null; repeated rows count as often as delivered; an empty table
gives no rows. Columns that are named neither as key nor in an aggregate are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import table, written

CHUNK_ROWS = 65_536
FAN_IN = 16

# state of a chunk from rows, and state of states; both are partial aggregates of Spark itself
_LEAF = {
    "count": lambda c: F.count(F.lit(1)) if c is None else F.count(c),
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "distinct": lambda c: F.hll_sketch_agg(c, F.lit(12)),
}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "distinct": lambda c: F.hll_union_agg(c)}


def tree_aggregate(df: DataFrame, keys: dict[str, Column], aggs: dict[str, tuple[str, Column | None]], chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """One row a key with the named aggregates; aggs maps a name to (count | sum | min | max | distinct, column).

    distinct is a HyperLogLog estimate, as exact distinct states have no bounded size.
    """
    clash = set(keys) & set(aggs)
    if clash:
        raise ValueError(f"names used twice: {sorted(clash)}")
    at = F.monotonically_increasing_id()  # the partition above 33 bits of the row's number within it
    leaf = F.shiftright(at, 33) * F.lit(1 << 20) + F.least(F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / chunk_rows), F.lit((1 << 20) - 1))
    inputs = {f"_in_{n}": c for n, (_, c) in aggs.items() if c is not None}
    rows = df.select(*(c.alias(n) for n, c in keys.items()), *(c.alias(n) for n, c in inputs.items()), leaf.alias("_leaf"))
    leaves = rows.groupBy(*keys, "_leaf").agg(*(_LEAF[kind](F.col(f"_in_{n}") if c is not None else None).alias(n) for n, (kind, c) in aggs.items()))
    # the number of chunks bounds the rounds
    states = written(leaves, "leaves")
    chunks = states.select(F.shiftright("_leaf", 20).alias("p"), F.col("_leaf").bitwiseAND(F.lit((1 << 20) - 1)).alias("c")).agg(F.max("p"), F.max("c")).first()
    width = (chunks[1] or 0) + 1
    n = ((chunks[0] or 0) + 1) * width
    states = states.withColumn("_leaf", F.shiftright("_leaf", 20) * width + F.col("_leaf").bitwiseAND(F.lit((1 << 20) - 1)))
    while True:
        n = -(-n // fan_in)
        if n > 1:
            states = states.withColumn("_leaf", F.floor(F.col("_leaf") / fan_in))
        by = (*keys, "_leaf") if n > 1 else tuple(keys)
        states = states.groupBy(*by).agg(*(_MERGE[kind](n_).alias(n_) for n_, (kind, _) in aggs.items()))
        if n <= 1:
            break
    return states.select(*keys, *(F.hll_sketch_estimate(n_).alias(n_) if kind == "distinct" else F.col(n_) for n_, (kind, _) in aggs.items()))


def species_key(species: Column) -> Column:
    """Species without blanks around, in lower case, a run of blanks and underscores as one underscore."""
    return F.lower(F.regexp_replace(F.regexp_replace(species, r"^\s+|\s+$", ""), r"[\s_]+", "_"))


def species_sags(annotations: DataFrame) -> DataFrame:
    """(species, n_rows, n_sags, n_sags_estimate): delivered rows and different SAGs of each species, exactly and by sketch.

    The rows are first aggregated by species and SAG, which splits a hot species, and these results by species.
    """
    pairs = {"species": species_key(F.col("species")), "sag": F.regexp_replace("sag_id", r"^\s+|\s+$", "")}
    each = written(tree_aggregate(annotations, pairs, {"n": ("count", None)}), "pairs")
    return tree_aggregate(each, {"species": F.col("species")}, {"n_rows": ("sum", F.col("n")), "n_sags": ("count", F.col("sag")), "n_sags_estimate": ("distinct", F.col("sag"))})


def bin_shares(bins: DataFrame) -> DataFrame:
    """(source_table, bin_id, declared, total): each bin once, with the declared SAGs of all bins of its source.

    A null declared_sags counts as 0. The total comes from the tree, so a source with very many bins is no hot group.
    """
    each = written(tree_aggregate(bins, {"source_table": F.col("source_table"), "bin_id": F.col("bin_id")}, {"declared": ("max", F.coalesce("declared_sags", F.lit(0)).cast("bigint"))}), "bins")
    totals = tree_aggregate(each, {"source_table": F.col("source_table")}, {"total": ("sum", F.col("declared"))})
    return each.join(totals, "source_table")


def hot_keys(annotations: DataFrame, bins: DataFrame, species_share: float = 0.02, bin_share: float = 0.1) -> DataFrame:
    """(in_table, hot_key): species and bins at or above their share.

    Null is no species, but its rows count in the total; a source whose bins declare nothing has no hot bin.
    """
    per = written(tree_aggregate(annotations, {"k": species_key(F.col("species"))}, {"n": ("count", None)}), "species")
    total = per.agg(F.sum("n")).first()[0] or 0
    species = per.filter(F.col("k").isNotNull() & (F.col("n") * round(1 / species_share) >= total)).select(F.lit("annotations").alias("in_table"), F.col("k").alias("hot_key"))
    shares = bin_shares(bins).filter((F.col("total") > 0) & (F.col("declared") * round(1 / bin_share) >= F.col("total")))
    return species.unionByName(shares.select(F.lit("bin_record").alias("in_table"), F.col("bin_id").alias("hot_key")))


def p5_found(spark, folder: str) -> DataFrame:
    return hot_keys(table(spark, folder, "annotations"), table(spark, folder, "bin_record"))


def p5_species(spark, folder: str) -> DataFrame:
    per = tree_aggregate(table(spark, folder, "annotations"), {"species": species_key(F.col("species"))}, {"n_rows": ("count", None), "first_at": ("min", F.col("annotated_at")), "last_at": ("max", F.col("annotated_at"))})
    return per.filter("species is not null")


def p5_bins(spark, folder: str) -> DataFrame:
    """(source_table, bin_id, declared, n_rows, total, n_members): delivered rows and different members of each bin, and what its source declares."""
    bins = table(spark, folder, "bin_record")
    by = {"source_table": F.col("source_table"), "bin_id": F.col("bin_id")}
    rows = tree_aggregate(bins, by, {"n_rows": ("count", None)})
    members = bins.select("source_table", "bin_id", F.explode("members").alias("member")).filter("member is not null")
    each = tree_aggregate(members, by | {"member": F.col("member")}, {"n": ("count", None)})
    counted = tree_aggregate(each, by, {"n_members": ("count", None)})
    out = bin_shares(bins).join(rows, ["source_table", "bin_id"]).join(counted, ["source_table", "bin_id"], "left")
    return out.select("source_table", "bin_id", "declared", "n_rows", "total", F.coalesce("n_members", F.lit(0)).alias("n_members"))


def p5_sags(spark, folder: str) -> DataFrame:
    """(species, n_rows, n_sags, estimate_close): the last says whether the sketch's number is within 10 percent, and two, of the exact one."""
    per = species_sags(table(spark, folder, "annotations")).filter("species is not null")
    return per.select("species", "n_rows", "n_sags", (F.abs(F.col("n_sags_estimate") - F.col("n_sags")) <= 0.1 * F.col("n_sags") + 2).alias("estimate_close"))
