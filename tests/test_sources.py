import gzip

import pytest

from seqloom.sources import fasta, tables


def test_read_sequences(spark, tmp_path):
    text = b">a first\tx\nACGT\nNN\n\n>b\r\nacgu\r\n>\n"
    (tmp_path / "sub").mkdir()
    variants = {"a.fna": text, "b.fa.gz": gzip.compress(text), "sub/c.fasta.gz": gzip.compress(text[:20]) + gzip.compress(text[20:]) + b"\0" * 9, "d.fasta.gz": text, "e.txt": text}
    for name, content in variants.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "q.fastq").write_bytes(b"@r1 c\r\nACGT\r\n+\r\n@@II\r\n@r2\nAC\nGT\n+r2\nII\nII\n@bad\nACGT\n+\nII\n")
    (tmp_path / "empty.fa").write_bytes(b"")
    rows = fasta.read_sequences(spark, str(tmp_path)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.path.rsplit("/", 1)[1], []).append((r.rec_idx, r.name, r.comment, r.seq, r.qual))
    want = [(0, "a", "first x", "ACGTNN", None), (1, "b", "", "acgu", None), (2, "", "", "", None)]
    assert {k: sorted(v) for k, v in by.items()} == {**{k: want for k in ("a.fna", "b.fa.gz", "c.fasta.gz", "d.fasta.gz")}, "q.fastq": [(0, "r1", "c", "ACGT", "@@II"), (1, "r2", "", "ACGT", "IIII")]}
    kept = fasta.normalised(fasta.read_sequences(spark, str(tmp_path / "a.fna"))).collect()
    assert [(r.name, r.seq, r.callable) for r in kept] == [("a", "ACGTNN", 4), ("b", "ACGT", 4)]


def test_write_merged(spark, tmp_path):
    df = spark.createDataFrame([("g1", "s1", "r1", "A" * 65), ("g1", "s2", "r2", "CC"), ("g2", "s3", "r", "G")], "species_group string, sag_id string, name string, seq string")
    path = str(tmp_path / "out")
    fasta.write_merged(df.coalesce(1), "species_group", "sag_id", path)
    rows = spark.read.text(path).collect()
    got = sorted((r.group, r.value) for r in rows)
    assert got == sorted([("g1", ">s1|r1"), ("g1", "A" * 60), ("g1", "AAAAA"), ("g1", ">s2|r2"), ("g1", "CC"), ("g2", ">s3|r"), ("g2", "G")])
    with pytest.raises(Exception, match="exist"):
        fasta.write_merged(df, "species_group", "sag_id", path)


def test_tables(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("﻿SAG \tTotal_BP\tx\nA\t 7 \tq\nB\tNA\tq\n")
    spec = {"sag_id": ("string", ["sag"]), "total_bp": ("bigint", [])}
    assert [tuple(r) for r in tables.strict_table(spark, str(tmp_path / "t.tsv"), spec).collect()] == [("A", 7), ("B", None)]
    with pytest.raises(ValueError, match="no column"):
        tables.strict_table(spark, str(tmp_path / "t.tsv"), {"gc": ("double", [])})
    (tmp_path / "bad.tsv").write_text("sag\ttotal_bp\nA\tx\n")
    with pytest.raises(Exception, match="CAST|cast|parse"):
        tables.strict_table(spark, str(tmp_path / "bad.tsv"), spec).collect()
    (tmp_path / "m.tsv").write_text("sag_id\tr1\tr2\nA b\t/x\t/y\nC\t/z\n")
    assert [tuple(r) for r in tables.manifest(spark, str(tmp_path / "m.tsv")).collect()] == [("A_b", "/x", "/y"), ("C", "/z", None)]
    for text in ("A\t/x\nA\t/y\n", "A\t/x\t/x\n", "A\t\n"):
        (tmp_path / "m2.tsv").write_text(text)
        with pytest.raises(ValueError):
            tables.manifest(spark, str(tmp_path / "m2.tsv"))
    (tmp_path / "l.txt").write_text("# c\n\n/abs/x.fa\nrel.fa\r\n")
    assert [r.path for r in tables.path_list(spark, str(tmp_path / "l.txt")).collect()] == ["/abs/x.fa", f"{tmp_path}/rel.fa"]
    (tmp_path / "none.txt").write_text("#\n")
    with pytest.raises(ValueError, match="empty"):
        tables.path_list(spark, str(tmp_path / "none.txt"))
