"""The registered queries of this part against their SQL, on the smallest tables."""

import collections
import glob
import os

import duckdb
import pytest

from seqloom.llm.queries import LLM, LLM_SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_same_rows(spark, con, name):
    df = LLM[name](spark, DATA)
    columns = sorted(df.columns)
    rel = con.sql(LLM_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    got = collections.Counter(tuple(r) for r in df.select(columns).collect())
    assert got == collections.Counter(tuple(r[i] for i in at) for r in rel.fetchall())


def test_columns_of_the_found_queries(spark):
    want = {"p2_found": ["contig_id", "span_start", "span_end"], "p3_found": ["group_id", "sag_id"], "p4_found": ["in_table", "keep_id", "copy_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "lang"]}
    for name, columns in want.items():
        assert LLM[name](spark, DATA).columns == columns
