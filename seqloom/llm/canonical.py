"""Duplicates hidden by differences of notation, by dictionary encoding.

Every record is a set of named fields. Each distinct raw value of a field is canonicalised once and the distinct
canonical values get integers; records become sorted tuples of field-value integers, and equal tuples are grouped.
What is shuffled per record is a tuple of integers, not text; long raw values stand by their SHA-256 until then.

Defined results: a null record, and one without any field, is no case; repeated rows are one record; the smallest id
of equal records is kept; groups of any size are counted and listed without bringing a group together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import table, written

#: fields whose names may be written with blanks and without separators before them; any other name is one word
FIELDS = ("sag", "records", "bases", "gc_bases", "min_length", "max_length", "id_set_sha256", "record_set_sha256")


def bare(text: Column) -> Column:
    """Letters and digits of a text in lower case; a number keeps its minus sign and decimal point.

    A point or comma before a group of just three digits parts thousands.
    """
    letters = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))
    inner = F.regexp_replace(text, r"^[^\p{L}\p{N}+.\-]+|[^\p{L}\p{N}]+$", "")
    number = F.regexp_replace(F.regexp_replace(inner, r"^[+]|[.]0+$", ""), r"([.]\d*[1-9])0+$", "$1")
    number = F.regexp_replace(F.regexp_replace(number, r"(\d),(?=\d{3}(?:\D|$))", "$1"), r"^(-?)(?=[.])", "$10")
    decimal = inner.rlike(r"^[+\-]?(?:\d+|\d{1,3}(?:,\d{3})+)?[.]\d+$") & ~inner.rlike(r"^[+\-]?[1-9]\d{0,2}(?:[.]\d{3})+$")
    return F.when(decimal | inner.rlike(r"^-\d+(?:,\d{3})*$"), number).otherwise(letters)


def _name(field: str) -> str:
    return r"[\s_.\-]*".join(field.split("_"))


def receipt_fields(receipt: Column) -> Column:
    """array<struct<field, raw>> of a receipt in any notation: a name, a colon or equals sign, and what follows up to the next name.

    Known names may stand anywhere, others at the begin of the text, of a line or after a separator.
    """
    known = r"(?<![A-Za-z0-9])[\"']?(?:" + "|".join(_name(f) for f in sorted(FIELDS, key=len, reverse=True)) + ")"
    other = r"(?<=^|[,;|&{\n\r\t])\s*[\"']?[A-Za-z][\w.\-]*"
    start = rf"(?i)(?:{known}|{other})[\"']?\s*[:=]"
    # marks of a control character cut the text into its fields
    cut = F.split(F.regexp_replace(receipt, f"({start})", "\x01$1"), "\x01")
    return F.transform(F.filter(cut, lambda p: p.rlike(f"^(?:{start})")), lambda p: F.struct(bare(F.regexp_extract(p, r"(?s)^([^:=]*)[:=](.*)$", 1)).alias("field"), F.trim(F.regexp_extract(p, r"(?s)^([^:=]*)[:=](.*)$", 2)).alias("raw")))


def encode(cells: DataFrame, canon) -> DataFrame:
    """(rec_id, code) from cells (rec_id, field, raw): distinct raw values are canonicalised once, canonical values numbered.

    Values with an empty canonical form have no code. Very frequent values make a skewed join side, which adaptive
    execution splits; the dictionary side has each value once.
    """
    raws = cells.select("field", "raw").distinct().withColumn("value", canon(F.col("raw"))).filter("value <> ''")
    return _coded(cells, written(raws, "raws"))


def encode_long(cells: DataFrame, canon) -> DataFrame:
    """encode for long raw values: these are told apart, and once canonical again, by SHA-256."""
    marked = cells.select("rec_id", "field", F.unhex(F.sha2("raw", 256)).alias("mark"), "raw").filter("raw is not null")
    raws = marked.groupBy("field", "mark").agg(F.first("raw").alias("raw"))  # equal marks, equal values
    raws = raws.withColumn("raw", canon(F.col("raw"))).filter("raw <> ''").select("field", F.col("mark").alias("raw"), F.unhex(F.sha2("raw", 256)).alias("value"))
    return _coded(marked.select("rec_id", "field", F.col("mark").alias("raw")), written(raws, "raws"))


def _coded(cells: DataFrame, raws: DataFrame) -> DataFrame:
    codes = written(raws.select("field", "value").distinct().withColumn("code", F.monotonically_increasing_id()), "codes")
    dictionary = written(raws.join(codes, ["field", "value"]).select("field", "raw", "code"), "dictionary")
    return cells.join(dictionary, ["field", "raw"]).select("rec_id", "code")


def tuples_of(coded: DataFrame) -> DataFrame:
    """(rec_id, key): the sorted codes of each record."""
    return written(coded.groupBy("rec_id").agg(F.array_sort(F.collect_set("code")).alias("key")), "tuples")


def copies_of(tuples: DataFrame) -> DataFrame:
    """(keep_id, copy_id) of tuples (rec_id, key): one row for each record but the smallest of its group."""
    keep = tuples.groupBy("key").agg(F.min("rec_id").alias("keep_id"), F.max("rec_id").alias("last")).filter("keep_id < last").drop("last")
    return tuples.join(keep, "key").filter("rec_id <> keep_id").select("keep_id", F.col("rec_id").alias("copy_id")).distinct()


def kept(tuples: DataFrame) -> DataFrame:
    """(keep_id, n_copies): the smallest record of each group of equal tuples and how many records it stands for, itself included."""
    return tuples.groupBy("key").agg(F.min("rec_id").alias("keep_id"), F.count("*").alias("n_copies")).drop("key")


def sequence_tuples(contig: DataFrame) -> DataFrame:
    """(rec_id, key) of contigs: the code of the letters of seq, without case."""
    letters = lambda raw: F.upper(F.regexp_replace(raw, r"[^\p{L}]+", ""))
    return tuples_of(encode_long(contig.select(F.col("contig_id").alias("rec_id"), F.lit("seq").alias("field"), F.col("seq").alias("raw")), letters))


def receipt_tuples(stats: DataFrame) -> DataFrame:
    """(rec_id, key) of receipts: the sorted codes of what they state."""
    cells = stats.filter("receipt is not null").select(F.col("stats_id").alias("rec_id"), F.explode(receipt_fields(F.col("receipt"))).alias("c")).select("rec_id", "c.field", "c.raw")
    return tuples_of(encode(written(cells, "cells"), bare))


def p4_found(spark, folder: str) -> DataFrame:
    seqs = copies_of(sequence_tuples(table(spark, folder, "contig"))).select(F.lit("contig").alias("in_table"), "keep_id", "copy_id")
    stats = copies_of(receipt_tuples(table(spark, folder, "fasta_stats"))).select(F.lit("fasta_stats").alias("in_table"), "keep_id", "copy_id")
    return seqs.unionByName(stats)


def p4_counts(spark, folder: str) -> DataFrame:
    """(in_table, keep_id, n_copies): one record of each group of equal ones, groups of one included, and how many there are."""
    seqs = kept(sequence_tuples(table(spark, folder, "contig"))).select(F.lit("contig").alias("in_table"), "keep_id", "n_copies")
    return seqs.unionByName(kept(receipt_tuples(table(spark, folder, "fasta_stats"))).select(F.lit("fasta_stats").alias("in_table"), "keep_id", "n_copies"))


_FOUND = """cells AS (SELECT stats_id AS id, f, regexp_extract_all(receipt, '(?i)(^|[^A-Za-z0-9_.-])' || replace(f, '_', '[\\s_.-]*') || '["'']?\\s*[:=]\\s*["'']?([^"''\\n;|,\\t}]*)', 2)[1] AS v
    FROM fasta_stats, unnest(['sag', 'records', 'bases', 'gc_bases', 'min_length', 'max_length', 'id_set_sha256', 'record_set_sha256']) AS u(f) WHERE receipt IS NOT NULL),
t AS (SELECT id, list(f || '=' || lower(regexp_replace(v, '[^A-Za-z0-9]+', '', 'g')) ORDER BY f) AS k FROM (SELECT DISTINCT * FROM cells WHERE v <> '') GROUP BY id),
s AS (SELECT DISTINCT contig_id AS id, upper(regexp_replace(seq, '[^A-Za-z]+', '', 'g')) AS k FROM contig),
found AS (SELECT 'fasta_stats' AS in_table, min(id) OVER (PARTITION BY k) AS keep_id, id AS copy_id FROM t
    UNION ALL SELECT 'contig', min(id) OVER (PARTITION BY k), id FROM s WHERE k <> '')"""

SQL = {
    "p4_found": f"WITH {_FOUND} SELECT * FROM found WHERE keep_id <> copy_id",
    "p4_counts": f"WITH {_FOUND} SELECT in_table, keep_id, count(*) AS n_copies FROM found GROUP BY 1, 2",
}
