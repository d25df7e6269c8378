import glob
import gzip
import hashlib

import pyarrow.parquet as pq
import pytest

from seqloom.operators import archive

T = "2024-01-0{} 00:00:00"


def listing(spark, rows):
    df = spark.createDataFrame(rows, "file_id bigint, path string, mtime string, file_text string")
    return df.selectExpr("file_id", "path", "cast(mtime as timestamp_ntz) as mtime", "file_text", "'x' as payload", "1 as w", "'y' as entries")


ROWS = [
    (1, "/a/./b//c.fa", T.format(1), ">old\nA"),
    (2, "/a/b/c.fa", T.format(2), ">new one\nAC\r\n>n2\tx\r\nGT\r\n"),
    (3, "/a/x/../b/c.fa", T.format(2), ">tie larger id\nA"),
    (4, "/a/empty.fa", T.format(1), ""),
    (5, "/a/null.fa", T.format(1), None),
    (6, None, T.format(1), ">lost\nA"),
    (7, "/../../r.fa", T.format(1), ">\nA\r>cr\rA"),
    (8, "rel/../../up.fa", T.format(1), "no header > here\n>z"),
    (9, "/big.fa", T.format(1), ">big\n" + "ACGT" * 500),
]


def test_paths(spark):
    cases = {"/a/b": "/a/b", "/a//b/./c/../d": "/a/b/d", "/..": "/", "/": "/", "a/../../b": "../b", "./a": "a", "/a/b/": "/a/b", "/a/..b/.c": "/a/..b/.c", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "path string")
    assert {r.path: r.p for r in df.select("path", archive.resolve_path(df.path).alias("p")).collect()} == cases


def test_records_and_index(spark):
    df = listing(spark, ROWS + ROWS[:4] + [ROWS[8]] * 200)
    blocks = archive.archive_of(df, block_bytes=64)
    assert sorted(tuple(r) for r in archive.archived_records(blocks).collect()) == sorted([("/a/b/c.fa", "tie"), ("/r.fa", ""), ("/r.fa", "cr"), ("../up.fa", "z"), ("/big.fa", "big")])
    index = {r.path: r for r in archive.archive_index(blocks).collect()}
    assert set(index) == {"/a/b/c.fa", "/a/empty.fa", "/a/null.fa", "/r.fa", "../up.fa", "/big.fa"} and index["/a/null.fa"].length == 0
    whole = {r.path: bytes(r.content) for r in archive.extract(blocks).collect()}
    assert all(hashlib.sha256(whole[p]).hexdigest() == r.sha256 for p, r in index.items())


def test_lookup_reads_its_files_only(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = [(i, f"/d/{i:03d}.fa", T.format(1), f">r{i}\n" + "ACGT" * 50) for i in range(300)]
    archive.write_archive(listing(spark, rows + rows[:9]), path, block_bytes=2000, file_blocks=3)
    blocks = archive.read_archive(spark, path)
    assert blocks.selectExpr("sum(n_files)").first()[0] == 300 and blocks.filter("block_bytes > 2000").isEmpty()
    per_file = [r["count"] for r in blocks.groupBy("_metadata.file_path").count().collect()]
    assert max(per_file) <= 3 and len(per_file) <= 45  # 62 kB, in blocks of 2 kB, three a file
    assert all(pq.ParquetFile(f).num_row_groups == pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/blocks/*.parquet"))
    wanted = spark.createDataFrame([("/d/007.fa",), ("/none",), ("/d/007.fa",), (None,)], "path string").selectExpr("*", "1 as block_id")
    found = archive.lookup(spark, path, wanted)
    assert [(r.path, r.file_id, bytes(r.content).decode()) for r in found.collect()] == [("/d/007.fa", 7, rows[7][3])]
    assert len([f for f in found.inputFiles() if "/blocks/" in f]) == 1
    assert archive.lookup(spark, path, wanted.filter("path = '/none'")).collect() == []
    with pytest.raises(Exception, match="exist"):
        archive.write_archive(listing(spark, ROWS), path)


def test_small_archives_are_one_file(spark, tmp_path):
    archive.write_archive(listing(spark, ROWS), str(tmp_path / "a"))
    assert len(glob.glob(f"{tmp_path}/a/blocks/*.parquet")) == 1


def test_one_listing_with_two_texts(spark):
    rows = [(1, "/a", T.format(1), ">x\nA"), (1, "/a", T.format(1), ">y\nA")]
    assert [tuple(r) for r in archive.archived_records(archive.archive_of(listing(spark, rows))).collect()] == [("/a", "y")]


def test_binary_files_keep_their_bytes(spark, tmp_path):
    content = gzip.compress(b">a\nACGT\n") + b"\x00\xff"
    files = spark.createDataFrame([("/z.gz", 1, bytearray(content))], "path string, file_id bigint, content binary").selectExpr("*", "timestamp_ntz'2024-01-01' as mtime")
    assert bytes(archive.extract(archive.pack_archive(files)).first().content) == content


def test_empty(spark):
    df = listing(spark, [])
    assert archive.archived_records(archive.archive_of(df)).collect() == []
