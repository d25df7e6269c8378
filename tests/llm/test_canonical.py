import json
import random

from pyspark.sql import functions as F

from seqloom.llm import canonical


def notations(rng, fields):
    keys = list(fields)
    rng.shuffle(keys)
    style = rng.choice([str.lower, str.upper, str.title, lambda k: k.replace("_", "-")])
    value = rng.choice([str, lambda v: str(v).upper(), lambda v: str(v).lower()])
    form = rng.randint(0, 4)
    items = [(style(k), value(fields[k])) for k in keys]
    if form == 0:
        return json.dumps(dict(items))
    if form == 1:
        return "; ".join(f"{k}={v}" for k, v in items)
    if form == 2:
        return "\n".join(f"{k}:\t{v}" for k, v in items)
    if form == 3:
        return " | ".join(f"{k}: '{v}'" for k, v in items)
    return ",".join(f"{k} = {v}" for k, v in items) + "\r\n"


def test_receipts(spark):
    rng = random.Random(2)
    digest = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(64))
    base = [{"sag": f"2404-S-{i}__BZ-ACGT{i}", "records": rng.randint(1, 3), "bases": i, "gc_bases": 7, "min_length": 1, "max_length": 9, "id_set_sha256": digest(), "record_set_sha256": digest()} for i in range(8)]
    base.append({k: v for k, v in base[0].items() if k != "bases"})  # states less, so is another record
    rows = [(i, i % 9 if i % 3 else 0) for i in range(150)]  # one record has a third of the copies
    data = [(i, notations(rng, base[b])) for i, b in rows] + [(500, None), (501, ""), (502, "nothing stated")]
    df = spark.createDataFrame(data + data[:30], "stats_id bigint, receipt string").selectExpr("*", "1 as rec_id", "'k' as key", "2 as code")
    got = [tuple(r) for r in canonical.copies_of(canonical.receipt_tuples(df)).collect()]
    first = {}
    want = {(first.setdefault(b, i), i) for i, b in rows if first.setdefault(b, i) != i}
    assert len(got) == len(set(got)) and set(got) == want


def test_fields_of_a_receipt(spark):
    row = spark.range(1).select(canonical.receipt_fields(F.lit('{"Gc-Bases" : "1,234", "sag": "a:b=c", "BASES": 7}')).alias("f")).first().f
    assert {(x.field, x.raw.strip('", }')) for x in row} == {("gcbases", "1,234"), ("sag", "a:b=c"), ("bases", "7")}


def test_sequences(spark):
    data = [(1, "AC gt\n"), (2, "acgt"), (3, "ACGT*"), (4, "ACGN"), (5, None), (6, " *\n"), (7, ""), (8, "acgn"), (9, "AC"), (1, "AC gt\n")]
    df = spark.createDataFrame(data, "contig_id bigint, seq string").selectExpr("*", "1 as raw", "'x' as key")
    assert {tuple(r) for r in canonical.copies_of(canonical.sequence_tuples(df)).collect()} == {(1, 2), (1, 3), (4, 8)}


def test_empty(spark):
    assert canonical.copies_of(canonical.sequence_tuples(spark.createDataFrame([], "contig_id bigint, seq string"))).collect() == []
    assert canonical.copies_of(canonical.receipt_tuples(spark.createDataFrame([], "stats_id bigint, receipt string"))).collect() == []


def test_unknown_fields_count_and_their_order_does_not(spark):
    data = [(1, "sag=x; bases=7; tool_version=2"), (2, "Tool-Version: 2\nBASES: 7\nSAG: x"), (3, '{"bases": 7, "sag": "X", "tool.version": "2"}'), (4, "sag=x; bases=7; tool_version=3"), (5, "sag=x; bases=7")]
    df = spark.createDataFrame(data, "stats_id bigint, receipt string")
    assert {tuple(r) for r in canonical.copies_of(canonical.receipt_tuples(df)).collect()} == {(1, 2), (1, 3)}


def test_numbers_keep_sign_and_decimal_point(spark):
    same = [["1.5", "'1.5'", "+1.50", " 1.5,"], ["15", "15.0", "15."], ["-3", '"-3"'], ["3"], ["1234", "1,234", "1.234"], ["1234.5", "1,234.5"], ["0.5", ".5"], ["A-1.5", "a 15", "a_1,5"], ["-1234", "-1,234"]]
    rows = spark.createDataFrame([(i, v) for i, values in enumerate(same) for v in values], "i int, v string").select("i", canonical.bare(F.col("v")).alias("b")).collect()
    assert len({r.b for r in rows}) == len({(r.i, r.b) for r in rows}) == len(same)


def test_every_record_is_counted(spark):
    df = spark.createDataFrame([(3, "ac"), (1, "AC"), (2, "gg"), (2, "gg"), (4, None)], "contig_id bigint, seq string")
    assert sorted(map(tuple, canonical.kept(canonical.sequence_tuples(df)).collect())) == [(1, 2), (2, 1)]
