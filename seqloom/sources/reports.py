"""Readers of the reports that tools leave: taxonomies, hit lists, alignment tables, logs, timings and graphs.

All work on rows of text (path, value), as spark.read.text with its file name gives them, or on columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fixed_width_taxonomy(lines: DataFrame) -> DataFrame:
    """(accession, taxonomy) of lines with a key of 15 characters, one character between, and the rest."""
    value = F.regexp_replace("value", "[\r\n]+$", "")
    return lines.filter(F.length(value) > 16).select(F.substring(value, 1, 15).alias("accession"), F.expr("substring(regexp_replace(value, '[\r\n]+$', ''), 17)").alias("taxonomy"))


def top_hits(genes: DataFrame) -> DataFrame:
    """(entity, gene, ord, family, evalue, bitscore) of genes (entity, gene, hits), hits as `family,evalue,bitscore;...`; ord is the place in the list."""
    rows = genes.select("entity", "gene", F.posexplode(F.split("hits", ";")).alias("ord", "cell")).filter("trim(cell) <> ''")
    cell = F.split("cell", ",")
    return rows.select("entity", "gene", "ord", F.trim(cell[0]).alias("family"), cell[1].cast("double").alias("evalue"), cell[2].cast("double").alias("bitscore"))


def best_per_family(hits: DataFrame) -> DataFrame:
    """The hit with the largest bitscore of each (entity, family), the first in gene and list order among equals."""
    by = Window.partitionBy("entity", "family").orderBy(F.desc("bitscore"), "gene", "ord")
    return hits.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def longest_markers(markers: DataFrame, least: int = 150) -> DataFrame:
    """The longest sequence of each (marker, entity) of at least so many letters without white space, the first by ord among equals."""
    rows = markers.withColumn("nt_len", F.length(F.regexp_replace("sequence", r"\s+", ""))).filter(F.col("nt_len") >= least)
    by = Window.partitionBy("marker", "entity").orderBy(F.desc("nt_len"), "ord")
    return rows.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def longest_alignments(rows: DataFrame) -> DataFrame:
    """(marker, a, b, pident, length) of alignments (marker, q, s, pident, length, ord): the longest of each unordered pair, the first by ord among equals; self hits are left out."""
    pairs = rows.filter("q <> s").select("marker", F.least("q", "s").alias("a"), F.greatest("q", "s").alias("b"), "pident", "length", "ord")
    by = Window.partitionBy("marker", "a", "b").orderBy(F.desc("length"), "ord")
    return pairs.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r", "ord")


def first_stamp(lines: DataFrame) -> DataFrame:
    """(path, at): the first `YYYY-MM-DD HH:MM:SS` of each log (path, ord, value)."""
    stamp = F.regexp_extract("value", r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)", 1)
    return lines.withColumn("at", F.try_to_timestamp(F.nullif(stamp, F.lit("")))).filter("at is not null").groupBy("path").agg(F.min_by("at", "ord").alias("at"))


def resource_use(lines: DataFrame) -> DataFrame:
    """(path, wall_s, user_s, system_s, peak_kb) of `time -v` reports (path, value)."""

    def said(name: str) -> Column:
        return F.max(F.nullif(F.regexp_extract("value", rf"^\s*{name}[^:]*(?:\([^)]*\))?: (.*\S)\s*$", 1), F.lit("")))

    clock = F.split(F.col("wall"), ":")
    seconds = F.aggregate(clock, F.lit(0.0), lambda a, x: a * 60 + x.cast("double"))
    found = lines.groupBy("path").agg(said(r"Elapsed \(wall clock\) time \(h:mm:ss or m:ss\)").alias("wall"), said(r"User time \(seconds\)").alias("user_s"), said(r"System time \(seconds\)").alias("system_s"), said(r"Maximum resident set size \(kbytes\)").alias("peak_kb"))
    return found.select("path", seconds.alias("wall_s"), F.col("user_s").cast("double"), F.col("system_s").cast("double"), F.col("peak_kb").cast("bigint"))


def consensus_pieces(records: DataFrame) -> DataFrame:
    """(contig, pos, coverage, seq) of records (name, comment, seq) whose comment is `pos coverage`."""
    part = F.split(F.trim("comment"), r"\s+")
    return records.select(F.col("name").alias("contig"), part[0].cast("bigint").alias("pos"), part[1].cast("double").alias("coverage"), "seq")


def composed_consensus(pieces: DataFrame) -> DataFrame:
    """(contig, length, coverage, seq): a contig's pieces in order of pos, and their coverage weighted by length."""
    listed = pieces.groupBy("contig").agg(F.array_sort(F.collect_list(F.struct("pos", "seq"))).alias("p"), F.sum(F.length("seq")).alias("length"), F.sum(F.col("coverage") * F.length("seq")).alias("w"))
    return listed.select("contig", "length", F.when(F.col("length") > 0, F.col("w") / F.col("length")).otherwise(0.0).alias("coverage"), F.array_join(F.transform("p", lambda x: x["seq"]), "").alias("seq"))


def piece_offsets(pieces: DataFrame) -> DataFrame:
    """pieces with `start`, their place in the composed contig."""
    before = Window.partitionBy("contig").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("start", F.coalesce(F.sum(F.length("seq")).over(before), F.lit(0)))


def rewritten_segments(lines: DataFrame, sequences: DataFrame) -> DataFrame:
    """Graph lines (ord, value) with the sequence of every `S` line taken from sequences (name, seq), where it has one."""
    cell = F.split("value", "\t")
    rows = lines.withColumn("name", F.when(F.startswith("value", F.lit("S\t")), F.get(cell, F.lit(1))))
    new = rows.join(sequences, "name", "left")
    joined = F.concat_ws("\t", F.lit("S"), "name", "seq", F.nullif(F.array_join(F.slice(cell, 4, 1000), "\t"), F.lit("")))
    return new.select("ord", F.when(F.col("seq").isNotNull(), joined).otherwise(F.col("value")).alias("value"))


def best_polished(hits: DataFrame, least: float = 0.9) -> DataFrame:
    """(q, t, start, end, covered) of edge hits (q, t, qs, qe, ql, ts, te): the target with the largest merged span, if it covers more than `least` of q."""
    per = hits.groupBy("q", "t").agg(F.min("ts").alias("start"), F.max("te").alias("end"), (F.max("qe") - F.min("qs")).alias("span"), F.max("ql").alias("ql"))
    best = per.groupBy("q").agg(F.min_by(F.struct("t", "start", "end", "span", "ql"), F.struct((-F.col("span")).alias("n"), "t")).alias("m")).select("q", "m.*")
    return best.withColumn("covered", F.col("span") / F.nullif("ql", F.lit(0))).filter(F.col("covered") > least).select("q", "t", "start", "end", "covered")
