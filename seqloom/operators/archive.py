"""Consolidation of many tiny files into indexed archive containers.

Small files are packed into large blocks that keep the original bytes; an index beside them holds path, block,
offset, length and SHA-256 of every file, and the archive file its block lies in. A block is one row with its bytes and
the index of what it holds, and a row group of its own, so that blocks are read in parallel and a single file is found
through the index without reading other archive files. Archive files hold FILE_BLOCKS blocks at most; few files of less
than a block are made, as tasks with less are joined before they pack.

Defined results: listings whose resolved paths agree are one file, of which the listing with the latest mtime, then
the largest file_id, counts (of several texts of that listing the largest); a null path is no file; a null text is an empty file, as is an empty one (kept in the
index with length 0); rows delivered twice are one listing; a file larger than a block gets a block of its own;
an empty listing gives an empty archive. Other columns of the listing are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, table, written

BLOCK_BYTES = 8 << 20
FILE_BLOCKS = 16
#: archive files that a lookup names one by one; a lookup in more reads them all
LOOKUP_FILES = 10_000
INDEX_TYPE = "array<struct<path:string,file_id:bigint,mtime:timestamp_ntz,offset:bigint,length:bigint,sha256:string>>"
BLOCK_SCHEMA = f"block_id string, payload binary, n_files int, block_bytes bigint, entries {INDEX_TYPE}"


def resolve_path(path: Column) -> Column:
    """Path without empty and `.` steps, `..` taking back the step before it (kept at the head of a relative path)."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    rooted = F.startswith(path, F.lit("/"))

    def step(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        up = F.when((F.size(done) > 0) & (last != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(
            F.when(rooted, done).otherwise(F.concat(done, F.array(s)))
        )
        return F.when(s == "..", up).otherwise(F.concat(done, F.array(s)))

    walked = F.aggregate(steps, F.array().cast("array<string>"), step)
    full = F.concat(F.when(rooted, F.lit("/")).otherwise(F.lit("")), F.array_join(walked, "/"))
    # most paths hold nothing to resolve and skip the walk
    return F.when(path.rlike(r"//|(^|/)[.]{1,2}(/|$)|./$"), full).otherwise(path)


def winning_listings(listing: DataFrame) -> DataFrame:
    """(path, file_id, mtime, size) of the listing that counts for each resolved path; size is that of its text in bytes."""
    narrow = listing.filter("path is not null").select(resolve_path(F.col("path")).alias("path"), F.struct("mtime", "file_id", F.coalesce(F.octet_length("file_text"), F.lit(0)).cast("bigint").alias("size")).alias("w"))
    return narrow.groupBy("path").agg(F.max("w").alias("w")).select("path", "w.file_id", "w.mtime", "w.size")


def with_texts(winners: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, file_id, mtime, file_text) of winning listings.

    The texts move once, by file_id, so that neither a path listed very often nor a row delivered very often lands in
    one task: repeats are combined before the shuffle.
    """
    texts = listing.groupBy("file_id", "mtime").agg(F.max("file_text").alias("file_text"))
    return winners.join(texts, ["file_id", "mtime"]).select("path", "file_id", "mtime", "file_text")


def _packer(block_bytes: int):
    entry = pa.struct([("path", pa.string()), ("file_id", pa.int64()), ("mtime", pa.timestamp("us")), ("offset", pa.int64()), ("length", pa.int64()), ("sha256", pa.string())])
    schema = pa.schema([("block_id", pa.string()), ("payload", pa.binary()), ("n_files", pa.int32()), ("block_bytes", pa.int64()), ("entries", pa.list_(entry))])

    def block(parts: list[bytes], entries: list[dict]) -> pa.RecordBatch:
        payload = b"".join(parts)
        name = hashlib.sha256("\n".join(f"{e['path']}\t{e['sha256']}" for e in entries).encode()).hexdigest()[:32]
        return pa.RecordBatch.from_pylist([{"block_id": name, "payload": payload, "n_files": len(entries), "block_bytes": len(payload), "entries": entries}], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, at = [], [], 0
        for batch in batches:
            for path, file_id, mtime, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = data or b""
                if entries and at + len(data) > block_bytes:
                    yield block(parts, entries)
                    parts, entries, at = [], [], 0
                entries.append({"path": path, "file_id": file_id, "mtime": mtime, "offset": at, "length": len(data), "sha256": hashlib.sha256(data).hexdigest()})
                parts.append(data)
                at += len(data)
        if entries:
            yield block(parts, entries)

    return pack


def pack_archive(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (block_id, payload, n_files, block_bytes, entries) of files (path, file_id, mtime, file_text or content).

    Each task streams its files into blocks of up to block_bytes, so a task holds one block and never a whole group.
    """
    content = F.col("content") if "content" in files.columns else F.col("file_text").cast("binary")
    return files.select("path", "file_id", F.col("mtime").cast("timestamp_ntz").alias("mtime"), content.alias("content")).mapInArrow(_packer(block_bytes), BLOCK_SCHEMA)


def _write_blocks(listing: DataFrame, path: str, block_bytes: int, file_blocks: int) -> None:
    winners = written(winning_listings(listing), "winners")
    size = winners.agg(F.sum("size")).first()[0] or 0
    blocks = pack_archive(with_texts(winners, listing).coalesce(max(1, -(-size // block_bytes))), block_bytes)
    # a block is a row group, so that a lookup skips the others of its file
    layout = {"compression": "zstd", "maxRecordsPerFile": file_blocks, "parquet.block.row.count.limit": 1}
    blocks.write.mode("errorifexists").options(**layout).parquet(path)


def write_archive(listing: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, file_blocks: int = FILE_BLOCKS) -> None:
    """Pack the current listings into `blocks` of an archive folder and write its `index`, sorted by path; refuses to overwrite."""
    _write_blocks(listing, f"{path}/blocks", block_bytes, file_blocks)
    blocks = read_archive(listing.sparkSession, path).select("block_id", "entries", F.col("_metadata.file_path").alias("file"))
    entries = blocks.select("block_id", "file", F.explode("entries").alias("e")).select("e.path", "e.file_id", "e.mtime", "file", "block_id", "e.offset", "e.length", "e.sha256")
    entries.repartitionByRange("path").sortWithinPartitions("path").write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/index")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("path string, file_id bigint, mtime timestamp_ntz, file string, block_id string, offset bigint, length bigint, sha256 string").parquet(f"{path}/index")


def archive_index(blocks: DataFrame) -> DataFrame:
    """(path, file_id, mtime, block_id, offset, length, sha256) without touching the payload column."""
    return blocks.select("block_id", F.explode("entries").alias("e")).select("e.path", "e.file_id", "e.mtime", "block_id", "e.offset", "e.length", "e.sha256")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    for batch in batches:
        for payload, entries in zip(batch.column(0), batch.column(1), strict=True):
            data = memoryview(payload.as_buffer())
            for e in entries.as_py():
                content = bytes(data[e["offset"] : e["offset"] + e["length"]])
                if hashlib.sha256(content).hexdigest() != e["sha256"]:
                    raise ValueError(f"{e['path']}: checksum differs from the archive's index")
                yield e, content


def lookup(spark: SparkSession, path: str, paths: DataFrame) -> DataFrame:
    """(path, file_id, content) of the archived files whose path is in paths, every checksum verified.

    The index tells which archive files hold them, and only these are read; of these, blocks that hold none are left out
    by their block_id. Paths that are not archived give no row.
    """
    wanted = written(read_index(spark, path).join(paths.select("path").filter("path is not null").distinct(), "path", "left_semi"), "wanted")
    files = [r["file"] for r in wanted.select("file").distinct().limit(LOOKUP_FILES + 1).collect()]
    if not files:
        return extract(read_archive(spark, path).limit(0))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(*files) if len(files) <= LOOKUP_FILES else read_archive(spark, path)
    ids = [r["block_id"] for r in wanted.select("block_id").distinct().limit(LOOKUP_FILES + 1).collect()]
    if len(ids) <= LOOKUP_FILES:
        blocks = blocks.filter(F.col("block_id").isin(ids))
    entries = wanted.groupBy("block_id").agg(F.collect_list(F.struct("path", "file_id", "mtime", "offset", "length", "sha256")).alias("entries"))  # bounded by a block
    return extract(blocks.select("block_id", "payload").join(entries, "block_id"))


def extract(blocks: DataFrame) -> DataFrame:
    """(path, file_id, content) of all files in the entries of blocks (payload, entries); every checksum is verified."""
    picked = blocks.select("payload", "entries")
    schema = pa.schema([("path", pa.string()), ("file_id", pa.int64()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for e, content in _verified(batches):
            rows.append({"path": e["path"], "file_id": e["file_id"], "content": content})
            held += len(content)
            if held > 4 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return picked.mapInArrow(run, "path string, file_id bigint, content binary")


def archived_records(blocks: DataFrame) -> DataFrame:
    """(path, record_name) of every FASTA record in the archive.

    A record starts at a line that begins with `>`; lines end in LF, CRLF or CR. Its name is what follows up to the
    first space, tab or line end, and may be empty.
    """
    schema = pa.schema([("path", pa.string()), ("record_name", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, names = [], []
        for e, content in _verified(batches):
            for line in content.decode("utf-8", "replace").replace("\r", "\n").split("\n") if b">" in content else ():
                if line[:1] == ">":
                    head = line[1:].split(" ", 1)[0].split("\t", 1)[0]
                    paths.append(e["path"])
                    names.append(head)
            if len(paths) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.string())], schema=schema)
                paths, names = [], []
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.string())], schema=schema)

    return blocks.select("payload", "entries").mapInArrow(run, "path string, record_name string")


def archive_of(listing: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of a listing's archive, written to the shared folder and read back."""
    path = new_path(listing.sparkSession, "archive")
    _write_blocks(listing, f"{path}/blocks", block_bytes, FILE_BLOCKS)
    return read_archive(listing.sparkSession, path)


def assembly_files(sag: DataFrame, index: DataFrame) -> DataFrame:
    """(sag_id, assembly, n_files, n_bytes): what the archive holds of each assembly, a file or a directory of files.

    An assembly without any archived file gets 0; null assemblies are left out; repeated registrations count once.
    """
    sags = sag.filter("id is not null and assembly is not null").select(F.col("id").alias("sag_id"), resolve_path(F.col("assembly")).alias("assembly")).distinct()
    folder = F.regexp_replace("path", "/[^/]*$", "")
    keys = index.select(F.explode(F.array("path", folder)).alias("assembly"), "length").groupBy("assembly").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    return sags.join(keys, "assembly", "left").select("sag_id", "assembly", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return archived_records(archive_of(table(spark, folder, "fasta_evidence")))


def p1_index(spark: SparkSession, folder: str) -> DataFrame:
    """The archive's index without the block's name and place, which depend on how the work was spread."""
    return archive_index(archive_of(table(spark, folder, "fasta_evidence"))).select("path", "file_id", "length", "sha256")


def p1_assemblies(spark: SparkSession, folder: str) -> DataFrame:
    return assembly_files(table(spark, folder, "sag"), archive_index(archive_of(table(spark, folder, "fasta_evidence"))))


def p1_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_id, n_bytes, content_sha256) of the archived files that are the assembly of a deleted SAG, read from a written archive."""
    at = new_path(spark, "archive")
    write_archive(table(spark, folder, "fasta_evidence"), at)
    gone = table(spark, folder, "sag").filter("deleted_at is not null and assembly is not null").select(resolve_path(F.col("assembly")).alias("path"))
    return lookup(spark, at, gone).select("path", "file_id", F.octet_length("content").cast("bigint").alias("n_bytes"), F.sha2("content", 256).alias("content_sha256"))
