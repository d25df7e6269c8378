from pyspark.sql import functions as F

from seqloom.operators import treeagg


def test_equals_group_by(spark):
    df = spark.range(5000).selectExpr("case when id % 3 = 0 then 'hot' when id % 101 = 0 then null else concat('k', id % 40) end as k", "if(id % 7 = 0, null, id) as v", "'z' as _leaf", "1 as p")
    df = df.unionByName(df.limit(50))
    aggs = {"n": ("count", None), "m": ("count", F.col("v")), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    want = {tuple(r) for r in df.groupBy("k").agg(F.count("*"), F.count("v"), F.sum("v"), F.min("v"), F.max("v")).collect()}
    for chunk, fan in ((65536, 16), (7, 2), (100, 3)):
        got = [tuple(r) for r in treeagg.tree_aggregate(df.repartition(5), {"k": F.col("k")}, aggs, chunk, fan).collect()]
        assert len(got) == len(want) and set(got) == want


def test_distinct_estimate(spark):
    df = spark.range(3000).selectExpr("id % 2 as k", "id % 500 as v")
    for r in treeagg.tree_aggregate(df, {"k": F.col("k")}, {"d": ("distinct", F.col("v"))}, 50, 2).collect():
        assert abs(r.d - 250) < 15


def test_hot_keys(spark):
    notes = spark.createDataFrame([(" Aa  _b ",)] * 3 + [("aa_b",)] * 2 + [(None,)] * 60 + [(f"s{i}",) for i in range(150)], "species string").selectExpr("*", "1 as k", "2 as n")
    bins = spark.createDataFrame([("b1", "t", 10), ("b1", "t", 10), ("b2", "t", 89), ("b3", "t", None), ("b4", "t", 1), ("b5", "u", None), ("b6", "v", 9), ("b7", "v", 91)], "bin_id string, source_table string, declared_sags int")
    assert {tuple(r) for r in treeagg.hot_keys(notes, bins).collect()} == {("annotations", "aa_b"), ("bin_record", "b1"), ("bin_record", "b2"), ("bin_record", "b7")}


def test_empty(spark):
    assert treeagg.hot_keys(spark.createDataFrame([], "species string"), spark.createDataFrame([], "bin_id string, source_table string, declared_sags int")).collect() == []
