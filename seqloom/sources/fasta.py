"""FASTA and FASTQ sources and sinks.

Files are read as binary rows, gzip or plain by their first bytes, and parsed where they lie; a table that holds the
text of files is parsed the same way. A file is one row, as a compressed file can only be read from its start.

Defined results: a null or empty file has no records; lines end in LF, CRLF or CR; text before the first record is
ignored; a FASTQ record whose quality is not as long as its sequence ends the file, as does a truncated one; names may
recur and be empty.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seqfuncs as fn
from ..operators.audit import multiset_digest

RECORD_SCHEMA = "path string, rec_idx int, name string, comment string, seq string, qual string"
#: suffixes that discovery takes
GLOB = "*.{fasta,fna,fa,fas,fastq,fq,fasta.gz,fna.gz,fa.gz,fas.gz,fastq.gz,fq.gz}"


def plain_bytes(content: bytes) -> bytes:
    """Content without gzip, of any number of members and with padding after them; plain content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def parse_records(content: bytes) -> Iterator[tuple[str, str, str, str | None]]:
    """(name, comment, seq, qual) of a FASTA or FASTQ file's content."""
    lines = io.TextIOWrapper(io.BytesIO(content), "utf-8", errors="replace", newline=None)
    starts = (">", "@")
    line = next(lines, "")
    while line and line[0] not in starts:
        line = next(lines, "")
    while line:
        mark, (name, _, comment) = line[0], line[1:].rstrip("\n").replace("\t", " ").partition(" ")
        seq, line = [], next(lines, "")
        while line and line[0] not in (">", "@", "+"):
            seq.append(line.strip())
            line = next(lines, "")
        text, qual = "".join(seq), None
        if line[:1] == "+" and mark == "@":
            qual, line = "", next(lines, "")
            while line and len(qual) < len(text):
                qual += line.strip()
                line = next(lines, "")
            if len(qual) != len(text):
                return
        yield name, comment.strip(), text, qual
        while line and line[0] not in starts:
            line = next(lines, "")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("rec_idx", pa.int32()), ("name", pa.string()), ("comment", pa.string()), ("seq", pa.string()), ("qual", pa.string())])
    for batch in batches:
        rows, size = [], 0
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for i, record in enumerate(parse_records(plain_bytes(content.as_py() or b""))):
                rows.append((path, i, *record))
                size += len(record[2])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 6, schema)], schema=schema)


def records_of(files: DataFrame) -> DataFrame:
    """Records of files (path, content binary or string)."""
    return files.select("path", F.col("content").cast("binary")).mapInArrow(_parse, RECORD_SCHEMA)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Records of all sequence files below a folder or matching a glob."""
    return records_of(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", GLOB).load(path).select("path", "content"))


def normalised(records: DataFrame) -> DataFrame:
    """records with seq as callable bases (upper case, U as T, others N) and their number; records without letters are left out."""
    seq = fn.callable_bases(F.col("seq"))
    return records.withColumn("seq", seq).filter("seq <> ''").withColumn("callable", fn.count_of(F.col("seq"), "ACGT"))


# fixed values: letters of the nucleotide alphabet with its codes for several bases
IUPAC = "ACGTURYSWKMBDHVN"


def strict_records(files: DataFrame) -> DataFrame:
    """(path, rec_idx, header, name, seq) of FASTA texts (path, content), as they stand but for line ends; seq is in upper case without white space.

    A record starts at a line that begins with `>`; rec_idx -1 is what stands before the first, with a null header. A
    file's text is one value, so files should be no larger than a task can hold.
    """
    text = F.regexp_replace(F.coalesce(F.col("content").cast("string"), F.lit("")), "\r\n?", "\n")
    parts = files.select("path", F.posexplode(F.split(F.concat(F.lit("\n"), text), "\n>")).alias("at", "part"))
    header = F.when(F.col("at") > 0, F.regexp_extract("part", "^([^\n]*)", 1))
    body = F.when(F.col("at") > 0, F.regexp_replace("part", "^[^\n]*", "")).otherwise(F.col("part"))
    rows = parts.select("path", (F.col("at") - 1).alias("rec_idx"), header.alias("header"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("seq"))
    return rows.withColumn("name", F.regexp_extract("header", "^([^ \t]*)", 1))


def fasta_faults(files: DataFrame) -> DataFrame:
    """(path, fault, n) of FASTA texts: `text_before_record`, `no_record`, `no_name`, `padded_header`, `not_ascii`, `repeated_name`, `no_sequence`, `bad_letter`, each with the number of records (or of names that recur)."""
    rows = strict_records(files)
    is_record = F.col("rec_idx") >= 0
    faults = F.array_compact(
        F.array(
            F.when(~is_record & (F.col("seq") != ""), "text_before_record"),
            F.when(is_record & (F.col("name") == ""), "no_name"),
            F.when(is_record & F.col("header").rlike(r"^\s|\s$"), "padded_header"),
            F.when(F.concat(F.coalesce("header", F.lit("")), "seq").rlike(r"[^\x00-\x7F]"), "not_ascii"),
            F.when(is_record & (F.col("seq") == ""), "no_sequence"),
            F.when(is_record & F.col("seq").rlike(f"[^{IUPAC}]"), "bad_letter"),
        )
    )
    each = rows.select("path", F.explode(faults).alias("fault")).groupBy("path", "fault").agg(F.count("*").alias("n"))
    names = rows.filter(is_record).groupBy("path", "name").count().filter("count > 1").groupBy("path").agg(F.count("*").alias("n")).select("path", F.lit("repeated_name").alias("fault"), "n")
    bare = rows.groupBy("path").agg(F.max("rec_idx").alias("last")).filter("last < 0").select("path", F.lit("no_record").alias("fault"), F.lit(1).cast("bigint").alias("n"))
    return each.unionByName(names).unionByName(bare)


def fasta_digests(files: DataFrame) -> DataFrame:
    """(path, records, bases, gc_bases, min_length, max_length, id_digest, record_digest) of FASTA texts; the digests are of the multisets of names and of records."""
    rows = strict_records(files).filter("rec_idx >= 0")
    n = F.length("seq").cast("bigint")
    stats = rows.groupBy("path").agg(F.count("*").alias("records"), F.sum(n).alias("bases"), F.sum(fn.count_of(F.col("seq"), "GC")).alias("gc_bases"), F.min(n).alias("min_length"), F.max(n).alias("max_length"))
    ids = multiset_digest(rows, ["path"], F.col("name")).select("path", F.col("digest").alias("id_digest"))
    whole = multiset_digest(rows, ["path"], F.concat_ws("\t", "name", "seq")).select("path", F.col("digest").alias("record_digest"))
    return stats.join(ids, "path").join(whole, "path")


def merged_headers(records: DataFrame, group: str, entity: str, mark: str = "|") -> DataFrame:
    """(group, text): FASTA lines of records (group, entity, name, seq) with `entity<mark>name` headers, 60 letters a line."""
    text = F.concat(F.lit(">"), F.col(entity), F.lit(mark), F.col("name"), F.lit("\n"), fn.wrapped(F.col("seq")))
    return records.select(F.col(group).alias("group"), text.alias("text"))


def write_merged(records: DataFrame, group: str, entity: str, path: str, mark: str = "|") -> None:
    """One folder of FASTA text a group; a large group is written by many tasks."""
    merged_headers(records, group, entity, mark).withColumn("text", F.regexp_replace("text", "\n$", "")).write.mode("errorifexists").partitionBy("group").text(path)
