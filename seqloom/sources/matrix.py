"""Stored reference matrices and word indexes: written once with a receipt, and refused when they do not match it.

A matrix is Parquet with one row of packed bits a reference, in the order of ref, and a receipt with the number and
length of rows and digests of rows and labels. An index is Parquet of (hash, entity) in ranges of the hash, with a
receipt of its parameters. Digests are sums over rows, so writing and checking are single parallel scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import multiset_digest
from ..operators.contracts import difference, refuse
from ..operators.search import posting_index
from ..session import written


def _row(*columns: str):
    return F.concat_ws("\t", *(F.hex(F.col(c)) if c == "bits" else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _digest(df: DataFrame, *columns: str) -> str:
    return multiset_digest(df, [], _row(*columns)).first()["digest"]


def _receipt(spark: SparkSession, path: str, row: dict, schema: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("errorifexists").json(f"{path}/receipt")


def write_matrix(rows: DataFrame, labels: DataFrame, path: str, row_bytes: int = 6912) -> None:
    """Write rows (ref, bits) and labels (ref, species) as a matrix; refuses to overwrite, repeated refs, other lengths and labels that do not name the refs."""
    rows = (rows if hasattr(rows, "_written_at") else written(rows.select("ref", "bits"), "matrix")).select("ref", "bits")
    refuse(rows.filter(F.col("bits").isNull() | (F.octet_length("bits") != row_bytes)).select("ref"), f"rows of other than {row_bytes} bytes")
    refuse(difference(rows, labels, ["ref"]), "labels and rows")
    rows.repartitionByRange("ref").sortWithinPartitions("ref").write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/rows")
    labels.select("ref", "species").write.mode("errorifexists").parquet(f"{path}/labels")
    receipt = {"n_rows": rows.count(), "row_bytes": row_bytes, "rows": _digest(rows, "ref", "bits"), "labels": _digest(labels, "ref", "species")}
    _receipt(rows.sparkSession, path, receipt, "n_rows bigint, row_bytes int, rows string, labels string")


def load_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ref, bits) and (ref, species) of a matrix, after a check of lengths, number, digests and key sets against its receipt."""
    receipt = spark.read.schema("n_rows bigint, row_bytes int, rows string, labels string").json(f"{path}/receipt").first()
    rows, labels = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/labels")
    refuse(rows.filter(F.coalesce(F.octet_length("bits"), F.lit(0)) != receipt["row_bytes"]).select("ref"), f"{path}: rows of other than {receipt['row_bytes']} bytes")
    found = {"n_rows": rows.count(), "rows": _digest(rows, "ref", "bits"), "labels": _digest(labels, "ref", "species")}
    odd = [k for k, v in found.items() if v != receipt[k]]
    if odd:
        raise ValueError(f"{path}: {', '.join(odd)} differ from the receipt")
    refuse(difference(rows, labels, ["ref"]), f"{path}: labels and rows")
    return rows, labels


def query_rows(rows: DataFrame, row_bytes: int = 6912) -> DataFrame:
    """rows (entity, bits) to search with, refused unless all have the length."""
    refuse(rows.filter(F.coalesce(F.octet_length("bits"), F.lit(0)) != row_bytes).select("entity"), f"queries of other than {row_bytes} bytes")
    return rows


def write_index(sketches: DataFrame, path: str, k: int, scale: int, max_posting: int = 1000) -> None:
    """Index of sketches (hash, entity) in ranges of the hash and sorted, so that a search prunes files and row groups; refuses to overwrite."""
    kept = written(posting_index(written(sketches, "sketches"), max_posting), "index")
    kept.repartitionByRange("hash").sortWithinPartitions("hash", "entity").write.mode("errorifexists").parquet(f"{path}/postings")
    receipt = {"n_postings": kept.count(), "k": k, "scale": scale, "max_posting": max_posting, "postings": _digest(kept, "hash", "entity")}
    _receipt(sketches.sparkSession, path, receipt, "n_postings bigint, k int, scale int, max_posting int, postings string")


def load_index(spark: SparkSession, path: str, k: int | None = None, scale: int | None = None) -> tuple[DataFrame, dict]:
    """Postings (hash, entity) and the parameters of an index, after a check of its receipt, of repeated postings and of their number a hash.

    The index's parameters hold; one that is asked for and differs is an error.
    """
    receipt = spark.read.schema("n_postings bigint, k int, scale int, max_posting int, postings string").json(f"{path}/receipt").first().asDict()
    for name, asked in (("k", k), ("scale", scale)):
        if asked is not None and asked != receipt[name]:
            raise ValueError(f"{path}: {name} is {receipt[name]} and not {asked}")
    postings = spark.read.parquet(f"{path}/postings")
    sizes = postings.groupBy("hash").agg(F.count("*").alias("n"), F.countDistinct("entity").alias("m"))
    refuse(sizes.filter((F.col("n") > receipt["max_posting"]) | (F.col("n") != F.col("m"))), f"{path}: postings repeated or too many")
    if postings.count() != receipt["n_postings"] or _digest(postings, "hash", "entity") != receipt["postings"]:
        raise ValueError(f"{path}: postings differ from the receipt")
    return postings, receipt


def relayout_index(spark: SparkSession, source: str, path: str, ranges: int) -> None:
    """An index again in another number of ranges, from its postings alone; its contents and digest stay."""
    postings, receipt = load_index(spark, source)
    postings.repartitionByRange(ranges, "hash").sortWithinPartitions("hash", "entity").write.mode("errorifexists").parquet(f"{path}/postings")
    _receipt(spark, path, receipt, "n_postings bigint, k int, scale int, max_posting int, postings string")
