"""References to records that do not exist, at the time of the reference.

Parents are range-partitioned by key and stored as sorted arrays per range. References get their range by a binary
search over the range bounds, and each range's references meet its parents in batches: a range that holds very many
references (a hot key) is split over several batches, to each of which the range's parents go. Batches are numbered and
a task gets one (of very many batches, every n-th), so the width of the stage follows the references. A batch is probed
vectorised by binary search, and only the distinct misses leave it.

Defined results: null is no reference; spaces and tabs around a key do not count, on either side; a blank key is a
reference like any other; a parent is there from registered_at on until before deleted_at (null: still there), for any
of its rows; a parent row with null registered_at makes the key known but is never there; a reference without time
is left out, as it belongs to no period. Repeated rows change nothing. Empty parents: every reference is missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import table, written

PARENTS_PER_RANGE = 20_000
BATCH_ROWS = 131_072
#: batches up to this number have a task each
TASKS = 20_000
#: rows of three numbers that are broadcast, at most
BROADCAST_ROWS = 500_000
FAR = np.iinfo(np.int64).max
REASONS = np.array(["", "missing", "late", "deleted"], dtype=object)


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Keys as objects that numpy compares bytewise."""
    return np.array(column.cast(pa.binary()).to_pylist(), dtype=object)


def _micros(column: pa.ChunkedArray | pa.Array, null: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.timestamp("us")).cast(pa.int64()), null).to_numpy(zero_copy_only=False)


def parent_ranges(parents: DataFrame, per_range: int = PARENTS_PER_RANGE) -> tuple[DataFrame, list[tuple[int, bytes]]]:
    """(range_id, key, since, until) of the parents, range-partitioned, and the number and lower bound of each range.

    The bounds are one key a range; their number is the number of parents over per_range. Where keys repeat, ranges may
    be empty, and these have none.
    """
    keyed = parents.select(F.regexp_replace("key", r"^[ \t]+|[ \t]+$", "").alias("key"), "since", "until").filter("key is not null").distinct()
    ranges = max(1, -(-parents.count() // per_range))
    ranged = written(keyed.repartitionByRange(ranges, "key").withColumn("range_id", F.spark_partition_id()), "parents")
    bounds = ranged.groupBy("range_id").agg(F.min("key").alias("low")).orderBy("range_id").collect()
    return ranged, [(r["range_id"], r["low"].encode()) for r in bounds]


def _assign(bounds: list[tuple[int, bytes]]):
    numbers, lows = np.array([n for n, _ in bounds] or [0], np.int32), np.array([low for _, low in bounds], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.full(batch.num_rows, numbers[0], np.int32)
            if len(lows) > 1:
                known = batch.column(1).dictionary_encode()  # a key that recurs in a batch is searched once
                found = np.searchsorted(lows, _bytes(known.dictionary), side="right") - 1
                at = numbers[np.maximum(found, 0)][known.indices.to_numpy(zero_copy_only=False)]
            rows = pa.table([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "range_id"])
            # a row delivered very often leaves a batch once, so its copies cannot fill one probe batch
            yield from rows.group_by(rows.column_names).aggregate([]).select(rows.column_names).to_batches()

    return run


def _probe(key, refs: pa.Table, parents: pa.Table) -> pa.Table:
    """Distinct (in_table, month, key, reason) of one batch of references against the sorted parents of its range."""
    order = pc.sort_indices(parents, sort_keys=[("key", "ascending"), ("since", "ascending")])
    parents = parents.take(order)
    known = parents.column("key").combine_chunks().dictionary_encode() if parents.num_rows else None
    ids = _bytes(known.dictionary) if known is not None else np.array([], dtype=object)
    if len(ids) > 1:  # Arrow sorts strings bytewise, as numpy compares bytes
        assert all(ids[:-1] < ids[1:])
    # what recurs in a batch is searched once
    said = refs.column("key").combine_chunks().dictionary_encode()
    place = np.searchsorted(ids, _bytes(said.dictionary)) if len(ids) else np.zeros(len(said.dictionary), np.int64)
    inside = np.minimum(place, max(len(ids) - 1, 0))
    hit = (ids[inside] == _bytes(said.dictionary)) if len(ids) else np.zeros(len(said.dictionary), bool)
    back = said.indices.to_numpy(zero_copy_only=False)
    hit, inside = hit.astype(bool)[back], inside[back].astype(np.int64)
    time = _micros(refs.column("at").combine_chunks(), 0)
    reason = np.where(hit, 0, 1)
    if len(ids):
        own = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        since = _micros(parents.column("since").combine_chunks(), FAR)
        until = _micros(parents.column("until").combine_chunks(), FAR)
        until = np.where(since == FAR, np.iinfo(np.int64).min, until)
        steps = np.unique(since)
        rank = own * (len(steps) + 1) + np.searchsorted(steps, since, side="left")
        # latest end among a key's rows up to each row: with the rows in order of key and start, a running maximum that restarts at each key
        ends = np.searchsorted(np.unique(until), until)
        running = np.maximum.accumulate(own * (len(until) + 1) + ends) - own * (len(until) + 1)
        latest = np.unique(until)[running]
        spot = np.searchsorted(rank, inside * (len(steps) + 1) + np.searchsorted(steps, time, side="right"), side="left") - 1
        started = (spot >= 0) & (own[np.maximum(spot, 0)] == inside) & (since[np.maximum(spot, 0)] <= time)
        there = started & (latest[np.maximum(spot, 0)] > time)
        reason = np.where(hit, np.where(there, 0, np.where(started, 3, 2)), 1)
    miss = reason > 0
    month = time[miss].astype("datetime64[us]").astype("datetime64[M]").astype(str)
    rows = pa.table({"in_table": refs.column("in_table").combine_chunks().filter(pa.array(miss)), "month_key": pa.array(month, pa.string()), "sag_id": refs.column("key").combine_chunks().filter(pa.array(miss)), "reason": pa.array(REASONS[reason[miss]], pa.string())})
    return rows.group_by(rows.column_names).aggregate([]).select(["in_table", "month_key", "sag_id", "reason"])


def orphan_references(references: DataFrame, parents: DataFrame, per_range: int = PARENTS_PER_RANGE, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Distinct (in_table, month_key, sag_id, reason) of references (in_table, key, at) that parents (key, since, until) do not hold.

    reason is `missing` (no such key), `late` (before the key's first start) or `deleted` (else).
    """
    ranged, bounds = parent_ranges(parents, per_range)
    refs = references.select("in_table", F.regexp_replace("key", r"^[ \t]+|[ \t]+$", "").alias("key"), F.col("at").cast("timestamp_ntz").alias("at")).filter("key is not null and at is not null")
    placed = written(refs.mapInArrow(_assign(bounds), "in_table string, key string, at timestamp_ntz, range_id int"), "references")
    counts = placed.groupBy("range_id").count().collect()  # one number a range
    if not counts:
        return placed.sparkSession.createDataFrame([], "in_table string, month_key string, sag_id string, reason string")
    splits, n = [], 0
    for r in sorted(counts):
        parts = -(-r["count"] // batch_rows)
        splits.append((r["range_id"], parts, n))
        n += parts
    # a row a range, sent along while these are few
    small = len(splits) <= BROADCAST_ROWS
    splits = placed.sparkSession.createDataFrame(splits, "range_id int, parts bigint, first bigint")
    splits = F.broadcast(splits) if small else splits
    tasks = min(n, TASKS)
    batched = placed.join(splits, "range_id").withColumn("batch", F.col("first") + F.pmod(F.xxhash64("at", "key"), "parts"))
    held = ranged.join(splits, "range_id").withColumn("batch", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)))
    ours = batched.select((F.col("batch") % tasks).cast("int").alias("task"), "batch", "in_table", "key", "at").repartitionById(tasks, "task")
    theirs = held.select((F.col("batch") % tasks).cast("int").alias("task"), "batch", "key", F.col("since").cast("timestamp_ntz").alias("since"), F.col("until").cast("timestamp_ntz").alias("until")).repartitionById(tasks, "task")
    out = ours.groupBy("task", "batch").cogroup(theirs.groupBy("task", "batch")).applyInArrow(_probe, "in_table string, month_key string, sag_id string, reason string")
    return out.distinct()


def p6_found(spark, folder: str) -> DataFrame:
    notes = table(spark, folder, "annotations").select(F.lit("annotations").alias("in_table"), F.col("sag_id").alias("key"), F.col("annotated_at").alias("at"))
    tasks = table(spark, folder, "sag_task").select(F.lit("sag_task").alias("in_table"), F.col("sag").alias("key"), F.col("created_at").alias("at"))
    sags = table(spark, folder, "sag").select(F.col("id").alias("key"), F.col("registered_at").alias("since"), F.col("deleted_at").alias("until"))
    return orphan_references(notes.unionByName(tasks), sags)
