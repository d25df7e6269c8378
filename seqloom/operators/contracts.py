"""Contracts between tables: bindings that refuse or report rows which do not fit.

Functions named `..._faults` return the rows that break a contract, one for each fault; `refuse` turns any into an error.
Everything is joins and aggregations by key, so a contract is checked over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seqfuncs as fn


def refuse(faults: DataFrame, what: str) -> None:
    """Raise ValueError with up to five of the faults, if there are any."""
    shown = faults.limit(5).collect()
    if shown:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in shown))


def close(left: Column, right: Column, relative: float = 1e-8, absolute: float = 1e-10) -> Column:
    """Whether two numbers are nearly equal; null equals null only."""
    near = F.abs(left - right) <= F.greatest(F.lit(relative) * F.greatest(F.abs(left), F.abs(right)), F.lit(absolute))
    return F.coalesce(near, left.isNull() & right.isNull())


def graph_faults(nodes: DataFrame, edges: DataFrame, weight: Column | None = None, relative: float = 1e-8, absolute: float = 1e-10) -> DataFrame:
    """(a, b, fault) of edges (a, b, ...) over nodes (node): `null_end`, `self_edge`, `unknown_node`, `repeated_pair` in either order, and with an expected weight over the edges' columns `weight_differs`.

    A pair is named once for each of its faults, its ends in order.
    """
    pair = edges.withColumn("_a", F.least("a", "b")).withColumn("_b", F.greatest("a", "b"))
    known = nodes.select(F.col("node")).filter("node is not null").distinct()
    whole = pair.filter("a is not null and b is not null")
    said = lambda rows, fault: rows.select(F.col("_a").alias("a"), F.col("_b").alias("b"), F.lit(fault).alias("fault"))
    out = said(pair.filter("a is null or b is null"), "null_end").unionByName(said(whole.filter("a = b"), "self_edge"))
    for end in ("_a", "_b"):
        out = out.unionByName(said(whole.join(known.withColumnRenamed("node", end), end, "left_anti"), "unknown_node"))
    out = out.unionByName(said(whole.groupBy("_a", "_b").count().filter("count > 1"), "repeated_pair"))
    if weight is not None:
        out = out.unionByName(said(whole.filter(~close(F.col("weight"), weight, relative, absolute)), "weight_differs"))
    return out.distinct()


def difference(left: DataFrame, right: DataFrame, keys: list[str], values: dict[str, tuple[float, float] | None] | None = None) -> DataFrame:
    """(keys, fault) of two tables that should hold the same keys once each: `missing` on the right, `extra` there, `repeated` on either side, `<value>_differs`.

    values maps a column of both to (relative, absolute) tolerances, or None for equality. Null keys equal each other.
    """
    values = values or {}
    side = lambda df, x: df.groupBy(*keys).agg(F.count("*").alias(f"_n{x}"), *(F.max(v).alias(f"_{v}{x}") for v in values)).withColumnsRenamed({k: f"_k{x}_{k}" for k in keys})
    a, b = side(left, 0), side(right, 1)
    match = [a[f"_k0_{k}"].eqNullSafe(b[f"_k1_{k}"]) for k in keys]
    both = a.join(b, match, "full_outer")
    faults = [F.when(F.col("_n1").isNull(), "missing"), F.when(F.col("_n0").isNull(), "extra"), F.when(F.greatest("_n0", "_n1") > 1, "repeated")]
    for v, tolerance in values.items():
        x, y = F.col(f"_{v}0"), F.col(f"_{v}1")
        same = x.eqNullSafe(y) if tolerance is None else close(x, y, *tolerance)
        faults.append(F.when(F.col("_n0").isNotNull() & F.col("_n1").isNotNull() & ~same, f"{v}_differs"))
    named = both.select(*(F.when(F.col("_n0").isNull(), F.col(f"_k1_{k}")).otherwise(F.col(f"_k0_{k}")).alias(k) for k in keys), F.explode(F.array_compact(F.array(*faults))).alias("fault"))
    return named


def bound(table: DataFrame, other: DataFrame, key: str, what: str = "binding") -> DataFrame:
    """table with the columns of other by key, each row of table once. A missing or repeated key in other is an error; further rows of other are ignored."""
    needed = table.select(key).distinct()
    held = other.join(needed, key, "left_semi")
    faults = difference(needed, held, [key])
    refuse(faults, what)
    return table.join(held, key)


def resolved_paths(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(path, how, id) of wanted paths (path) among known ones (path, id): by the whole path, else by a file name that only one known path has.

    how is `path`, `name`, `ambiguous` or `none`; the last two have a null id. Every wanted path gives one row; of several
    ids of one whole path the smallest counts.
    """
    asked = wanted.select("path").filter("path is not null").distinct().withColumn("name", fn.base_name(F.col("path")))
    whole = known.filter("path is not null").groupBy("path").agg(F.min("id").alias("by_path"))
    names = whole.groupBy(fn.base_name(F.col("path")).alias("name")).agg(F.count("*").alias("n"), F.min("by_path").alias("by_name"))
    met = asked.join(whole, "path", "left").join(names, "name", "left")
    how = F.when(F.col("by_path").isNotNull(), "path").when(F.col("n") == 1, "name").when(F.col("n") > 1, "ambiguous").otherwise("none")
    return met.select("path", how.alias("how"), F.coalesce("by_path", F.when(F.col("n") == 1, F.col("by_name"))).alias("id"))


def header_members(headers: DataFrame, members: DataFrame) -> DataFrame:
    """(header, member) of merged headers (header): the longest declared member (member) that the header begins with, followed by `|`, `__` or its end.

    Only the beginnings that such a mark ends are looked up, so there is no join by prefix. A header without one has null.
    """
    rows = headers.select("header").filter("header is not null").distinct()
    ends = F.transform(F.sequence(F.lit(1), F.length("header")), lambda i: F.when(F.substring("header", i, F.lit(1)).eqNullSafe("|") | F.substring("header", i, F.lit(2)).eqNullSafe("__"), i - 1))
    cuts = rows.withColumn("cut", F.explode(F.array_append(F.array_compact(ends), F.length("header"))))
    tried = cuts.select("header", F.substring("header", F.lit(1), F.col("cut")).alias("member"))
    found = tried.join(members.select("member").distinct(), "member", "left_semi").groupBy("header").agg(F.max_by("member", F.length("member")).alias("member"))
    return rows.join(found, "header", "left")


# fixed values: reasons of a rejected entity
REASONS = ("rejected_or_no_hit", "negative", "no_hit", "rejected")


def is_rejection(reason: Column) -> Column:
    return F.lower(F.trim(reason)).isin(*REASONS)
