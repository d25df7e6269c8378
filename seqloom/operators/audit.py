"""Audits: closure of key sets, digests, structure statistics, coverage, recall and time series checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def key_closure(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, state): keys (key) of which one side lacks a copy, `missing` on the right or `extra` there, or that the right holds more than once (`duplicate`). Null keys do not count."""
    a = left.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    b = right.filter("key is not null").groupBy("key").agg(F.count("*").alias("m"))
    both = a.join(b, "key", "full_outer")
    state = F.when(F.col("m").isNull(), "missing").when(F.col("n").isNull(), "extra").when(F.col("m") > 1, "duplicate")
    return both.select("key", state.alias("state")).filter("state is not null")


def partition_closure(parts: DataFrame, whole: DataFrame) -> DataFrame:
    """One row (n_whole, n_assigned, n_unassigned, n_foreign, n_twice) of parts (part, key) against whole (key)."""
    a = parts.filter("key is not null").groupBy("key").agg(F.countDistinct("part").alias("n"))
    both = a.join(whole.filter("key is not null").distinct().withColumn("known", F.lit(True)), "key", "full_outer")
    return both.agg(
        F.count_if("known").alias("n_whole"), F.count_if(F.col("known") & F.col("n").isNotNull()).alias("n_assigned"), F.count_if(F.col("known") & F.col("n").isNull()).alias("n_unassigned"), F.count_if(F.col("known").isNull()).alias("n_foreign"), F.count_if(F.col("n") > 1).alias("n_twice")
    )


def _digest_parts(value: Column) -> list[Column]:
    """Sums, over rows, of the four 60-bit numbers at the head of a value's SHA-256; null values add nothing."""
    return [F.coalesce(F.sum(F.conv(F.substring(F.sha2(value, 256), 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)") for i in range(4)]


def multiset_digest(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, n, digest): digest of the multiset of a key's values; the order of rows does not matter, repeats do.

    SHA-256 over the number of rows and four sums of parts of the values' own SHA-256. Sums are combined before the
    shuffle, so a key with most rows is no task of its own. Null values count as rows only. Without keys, one row.
    """
    parts = _digest_parts(F.col("_v"))
    out = df.select(*keys, value.alias("_v")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(p.alias(f"_{i}") for i, p in enumerate(parts)))
    return out.select(*keys, "n", F.sha2(F.concat_ws("|", "n", "_0", "_1", "_2", "_3"), 256).alias("digest"))


def ordered_digest(df: DataFrame, key: str, order: list[str], value: Column) -> DataFrame:
    """(key, n, digest): digest of a key's values in order, which must be total; null values have a place but no digest.

    Rows are ranked over all keys at once in ranges, and each value is digested with its place in the key, so that no
    key's rows have to come together.
    """
    ranked = global_rank(df.select(key, *order, value.alias("_v")), key, *order)
    first = ranked.groupBy(F.col(key).alias("_key")).agg(F.min("rank").alias("_first"))
    both = ranked.join(first, F.col(key).eqNullSafe(F.col("_key"))).select(key, (F.col("rank") - F.col("_first")).alias("_i"), "_v")
    return multiset_digest(both, [key], F.concat(F.col("_i").cast("string"), F.lit(":"), F.col("_v")))


def n50(lengths: DataFrame, key: str, length: str) -> DataFrame:
    """(key, n, total, n50): smallest length at which the longest records hold half of the letters.

    Runs over the different lengths of a key, of which there are far fewer than records.
    """
    each = lengths.filter(F.col(length) > 0).groupBy(key, length).agg(F.count("*").alias("_n"))
    longer = Window.partitionBy(key).orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0)
    run = each.withColumn("_c", F.sum(F.col(length) * F.col("_n")).over(longer)).withColumn("_t", F.sum(F.col(length) * F.col("_n")).over(Window.partitionBy(key)))
    half = F.floor((F.col("_t") + 1) / 2)
    return run.groupBy(key).agg(F.sum("_n").alias("n"), F.first("_t").alias("total"), F.max(F.when(F.col("_c") >= half, F.col(length))).alias("n50"))


#: positions that one group of intervals spans
STRETCH = 1 << 16


def interval_union(df: DataFrame, key: str, start: str, end: str, stretch: int = STRETCH) -> DataFrame:
    """(key, n_islands, covered): length of the union of half-open intervals; empty and null ones do not count.

    Intervals are cut at the ends of stretches, united within each, and islands that meet at such an end are one.
    """
    rows = df.filter(F.col(start) < F.col(end)).select(key, F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_e")).distinct()
    cut = rows.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_s") / stretch), F.floor((F.col("_e") - 1) / stretch))))
    cut = cut.select(key, "_b", F.greatest("_s", F.col("_b") * stretch).alias("_s"), F.least("_e", (F.col("_b") + 1) * stretch).alias("_e")).distinct()
    by = Window.partitionBy(key, "_b").orderBy("_s", "_e")
    cut = cut.withColumn("_r", F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    cut = cut.withColumn("_i", F.sum(F.when(F.col("_s") <= F.col("_r"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    islands = cut.groupBy(key, "_b", "_i").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    stretches = islands.groupBy(key, "_b").agg(F.count("*").alias("_n"), F.sum(F.col("_e") - F.col("_s")).alias("_len"), F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    onward = Window.partitionBy(key).orderBy("_b")  # one row a stretch
    met = stretches.withColumn("_met", F.coalesce((F.lag("_e").over(onward) == F.col("_s")).cast("int"), F.lit(0)))
    return met.groupBy(key).agg(F.sum(F.col("_n") - F.col("_met")).alias("n_islands"), F.sum("_len").alias("covered"))


def coverage_windows(df: DataFrame, key: str, start: str, end: str, width: int = 100, least: int = 20) -> DataFrame:
    """(key, n_windows, upper_median, threshold): windows that intervals touch, by how many do."""
    rows = df.filter((F.col(start) < F.col(end)) & (F.col(start) >= 0))
    hit = rows.select(key, F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))).alias("w")).groupBy(key, "w").agg(F.count("*").alias("n"))
    depths = hit.groupBy(key, "n").agg(F.count("*").alias("m"))  # windows by depth
    upto = F.sum("m").over(Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("m").over(Window.partitionBy(key))
    ranked = depths.withColumn("_upto", upto).withColumn("_all", total)
    out = ranked.groupBy(key).agg(F.first("_all").alias("n_windows"), F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col("n"))).alias("upper_median"))
    return out.select(key, F.col("n_windows").cast("int").alias("n_windows"), "upper_median", F.greatest(F.lit(least).cast("bigint"), "upper_median").alias("threshold"))


def depth_segments(df: DataFrame, key: str, start: str, end: str, stretch: int = STRETCH) -> DataFrame:
    """(key, seg_start, seg_end, depth): maximal segments of equal depth above 0, from interval ends and not from positions.

    Depths run within stretches and start with what the stretches before leave.
    """
    rows = df.filter(F.col(start) < F.col(end))
    events = rows.select(key, F.col(start).alias("at"), F.lit(1).alias("d")).unionByName(rows.select(key, F.col(end).alias("at"), F.lit(-1).alias("d"))).groupBy(key, "at").agg(F.sum("d").alias("d")).filter("d <> 0")
    events = written(events.withColumn("_b", F.floor(F.col("at") / stretch)), "events")
    onward = Window.partitionBy(key).orderBy("_b")  # one row a stretch
    carried = events.groupBy(key, "_b").agg(F.sum("d").alias("_d"), F.min("at").alias("_first"))
    carried = carried.withColumn("_base", F.coalesce(F.sum("_d").over(onward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_next", F.lead("_first").over(onward)).drop("_d", "_first")
    by = Window.partitionBy(key, "_b").orderBy("at")
    run = events.withColumn("_run", F.sum("d").over(by)).withColumn("_lead", F.lead("at").over(by)).join(carried, [key, "_b"])
    run = run.withColumn("depth", F.col("_base") + F.col("_run")).withColumn("seg_end", F.coalesce("_lead", "_next"))
    return run.filter("depth > 0").select(key, F.col("at").alias("seg_start"), "seg_end", "depth")


def global_rank(df: DataFrame, *order: str | Column) -> DataFrame:
    """df with its 0-based rank in a total order: sorted in ranges, each range ranked on its own and offset by those before."""
    at = F.monotonically_increasing_id()
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ranked")
    rows = rows.withColumn("_p", F.shiftright("_at", 33))
    counts = rows.groupBy("_p").agg(F.count("*").alias("n"))
    offsets = counts.select("_p", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return rows.join(F.broadcast(offsets), "_p").withColumn("rank", F.col("_o") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_p", "_o", "_at")


def systematic_sample(df: DataFrame, key: str, every: int = 4) -> DataFrame:
    """Every n-th distinct key in byte order, from the first on."""
    return global_rank(df.filter(F.col(key).isNotNull()).select(key).distinct(), key).filter(F.col("rank") % every == 0)


def monotonic_series(df: DataFrame, key: str, at: str, ordinal: str, value: str) -> DataFrame:
    """(key, n, low, high, first, last, n_falls) of a value over time; ties in time are in the ordinal's order."""
    by = Window.partitionBy(key).orderBy(at, ordinal)
    rows = df.withColumn("_p", F.lag(value).over(by))
    when = F.struct(at, ordinal)
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.min_by(value, when).alias("first"), F.max_by(value, when).alias("last"), F.count_if(F.col(value) < F.col("_p")).alias("n_falls"))


def candidate_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row (n_truth, n_found, n_missed, recall) of pairs (a, b) against candidate pairs in canonical order."""
    found = truth.select("a", "b").distinct().join(candidates.select("a", "b").distinct().withColumn("hit", F.lit(True)), ["a", "b"], "left")
    n, hit = F.count("*"), F.count_if(F.coalesce("hit", F.lit(False)))
    return found.agg(n.alias("n_truth"), hit.alias("n_found"), (n - hit).alias("n_missed"), F.when(n > 0, F.round(hit / n, 6)).alias("recall"))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, low, median, high): of values that are not null; the median of an even number is the mean of the middle two."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.median(value).alias("median"), F.max(value).alias("high"))


def run_comparison(runs: DataFrame, key: str, run: str, seconds: str, peak: str, output: str) -> DataFrame:
    """(key, n_runs, mean_seconds, mean_peak, same_output): a key's runs, whose parts are first added up (seconds) or maximised (peak)."""
    each = runs.groupBy(key, run).agg(F.sum(seconds).alias("_s"), F.max(peak).alias("_p"), F.min(output).alias("_a"), F.max(output).alias("_b"))
    return each.groupBy(key).agg(F.count("*").alias("n_runs"), F.avg("_s").alias("mean_seconds"), F.avg("_p").alias("mean_peak"), (F.min("_a") == F.max("_b")).alias("same_output"))
