"""The core's registered queries against their SQL, on the smallest tables."""

import collections
import glob
import os

import duckdb
import pytest

from seqloom.plans.audits import AUDITS, AUDITS_SQL
from seqloom.plans.catalog import CATALOG, CATALOG_SQL, flagship
from seqloom.plans.general import GENERAL
from seqloom.plans.general_sql import GENERAL_SQL

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = {**GENERAL, **CATALOG, **AUDITS}, {**GENERAL_SQL, **CATALOG_SQL, **AUDITS_SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    plain = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    got = collections.Counter(plain(r) for r in df.select(columns).collect())
    assert got == collections.Counter(plain([r[i] for i in at]) for r in rel.fetchall())


def test_flagship(spark):
    assert flagship(spark, DATA).columns == ["contig_id", "ref", "dist", "second", "species"]


def test_core_does_not_need_the_text_part():
    folder = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "seqloom")
    for path in glob.glob(f"{folder}/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            assert "llm" not in open(path).read(), path
