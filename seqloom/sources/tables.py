"""Strict readers of delimited tables: path lists, manifests, and tables with a checked header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seqfuncs as fn


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """(path) of a list file, without blank lines and comments; relative ones are below the list's folder. Refuses an empty list."""
    text = F.trim(F.regexp_replace("value", "^﻿|\r$", ""))
    rows = spark.read.text(path).select(text.alias("path"), F.col("_metadata.file_path").alias("at")).filter("path <> '' and not startswith(path, '#')")
    rows = rows.select(F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.regexp_replace("at", "^file:(//)?|/[^/]*$", ""), F.lit("/"), "path")).alias("path"))
    if rows.isEmpty():
        raise ValueError(f"{path}: the list is empty")
    return rows


def strict_table(spark: SparkSession, path: str, columns: dict[str, tuple[str, list[str]]], sep: str = "\t") -> DataFrame:
    """A delimited file as typed columns; columns maps a name to (type, other names a header may use, in any case).

    A missing or doubled column, and a cell that its type cannot hold, is an error; `NA` and empty cells are null.
    """
    raw = spark.read.option("sep", sep).option("header", "true").option("mode", "FAILFAST").option("nullValue", "NA").csv(path)
    clean = [c.lstrip("﻿").strip().lower() for c in raw.columns]
    picked = []
    for name, (kind, aliases) in columns.items():
        at = [i for i, c in enumerate(clean) if c in {name.lower(), *(a.lower() for a in aliases)}]
        if len(at) != 1:
            raise ValueError(f"{path}: {'no' if not at else 'more than one'} column {name}")
        picked.append(F.nullif(F.trim(F.col(f"`{raw.columns[at[0]]}`")), F.lit("")).cast(kind).alias(name))
    return raw.select(*picked)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(sag_id, source1, source2) of a manifest of two or three columns with or without a header; ids are made safe.

    Refuses doubled ids and a pair of equal mates.
    """
    cells = F.split(F.regexp_replace("value", "^﻿|\r$", ""), "\t")
    rows = spark.read.text(path).filter("trim(value) <> '' and not startswith(value, '#')").select(cells.alias("c"))
    rows = rows.filter(~F.lower(F.trim(F.col("c")[0])).isin("sag_id", "id", "sample"))
    rows = rows.select(fn.safe_id(F.trim(F.col("c")[0])).alias("sag_id"), F.trim(F.get("c", F.lit(1))).alias("source1"), F.nullif(F.trim(F.get("c", F.lit(2))), F.lit("")).alias("source2"))
    bad = rows.filter("source1 is null or source1 = '' or source1 = source2").limit(1).count() + rows.groupBy("sag_id").count().filter("count > 1").limit(1).count()
    if bad:
        raise ValueError(f"{path}: an id is given twice, or a source is missing or equal to its mate")
    return rows


def mate_pairs(paths: DataFrame) -> DataFrame:
    """(read_id, r1, r2, complete) of read files (path): exactly one of each mate makes a pair complete."""
    rows = paths.select(fn.read_id(F.col("path")).alias("read_id"), fn.mate(F.col("path")).alias("mate"), "path").filter("mate is not null").distinct()
    out = rows.groupBy("read_id").agg(F.min(F.when(F.col("mate") == 1, F.col("path"))).alias("r1"), F.min(F.when(F.col("mate") == 2, F.col("path"))).alias("r2"), F.count("*").alias("n"))
    return out.select("read_id", "r1", "r2", (F.col("r1").isNotNull() & F.col("r2").isNotNull() & (F.col("n") == 2)).alias("complete"))
