import datetime as dt
import random

import pytest

from seqloom.operators import orphans

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def brute(refs, parents):
    held = {}
    for key, since, until in parents:
        if key is not None:
            held.setdefault(key.strip(" \t"), []).append((since, until))
    out = set()
    for t, key, when in refs:
        if key is None or when is None:
            continue
        key = key.strip(" \t")
        rows = held.get(key)
        if rows is None:
            reason = "missing"
        elif any(s is not None and s <= when and (u is None or when < u) for s, u in rows):
            continue
        else:
            reason = "late" if all(s is None or when < s for s, _ in rows) else "deleted"
        out.add((t, f"{at(when):%Y-%m}", key, reason))
    return out


@pytest.mark.parametrize(("per_range", "batch"), [(20000, 131072), (7, 20)])
def test_equals_brute_force(spark, per_range, batch):
    rng = random.Random(per_range)
    parents = [(f"k{rng.randint(0, 60):02d}" + rng.choice(["", "", " "]), rng.choice([None, *range(0, 300)]), rng.choice([None, *range(0, 300)])) for _ in range(90)] + [(None, 1, 2)]
    refs = [(rng.choice("ab"), rng.choice([None, "k03", "k03", f"\tk{rng.randint(0, 80):02d} ", "", "Z", "zz"]), rng.choice([None, *range(-40, 400)])) for _ in range(1500)]
    df = spark.createDataFrame([(t, k, at(w)) for t, k, w in refs + refs[:99]], "in_table string, key string, at timestamp_ntz").selectExpr("*", "1 as range_id", "2 as part")
    held = spark.createDataFrame([(k, at(s), at(u)) for k, s, u in parents + parents[:9]], "key string, since timestamp_ntz, until timestamp_ntz").selectExpr("*", "'x' as reason")
    got = [tuple(r) for r in orphans.orphan_references(df, held, per_range, batch).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(refs, parents)


def test_empty(spark):
    refs = spark.createDataFrame([("a", "k", at(1))], "in_table string, key string, at timestamp_ntz")
    none = spark.createDataFrame([], "key string, since timestamp_ntz, until timestamp_ntz")
    assert [tuple(r) for r in orphans.orphan_references(refs, none).collect()] == [("a", "2024-01", "k", "missing")]
    assert orphans.orphan_references(refs.limit(0), none).collect() == []
