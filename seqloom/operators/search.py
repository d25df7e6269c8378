"""Nearest references: exhaustive search over bit sketches with margin acceptance, and search through an inverted index.

Every query is compared with every reference, in blocks of at most BLOCK_BYTES: references lie in ranges of their order,
queries in blocks of their own, and a pair of blocks is one task's work. So the references move once for every
BLOCK_BYTES of queries. Nothing is broadcast and nothing but a block's best leaves it. Where few bits differ from the usual
one, a block is compared through them, with the same distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread, written

NO_SECOND = 2_147_483_647
MIN_RATIO = 0.01
BLOCK_BYTES = 64 << 20
#: pairs of blocks up to this number have a task each
TASKS = 20_000
#: eight-byte words compared at once
_AT_ONCE = 1 << 17
#: postings of references held at once
_POSTINGS = 1 << 22


def sign_bits(vectors: DataFrame) -> DataFrame:
    """(entity, bits) of vectors (entity, embedding): a bit for each positive component; null vectors are left out."""
    kind = vectors.schema["entity"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.array(v, np.float64) > 0).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["entity", "bits"])

    return vectors.filter("embedding is not null").select("entity", "embedding").mapInArrow(run, f"entity {kind.simpleString()}, bits binary")


def accepted(best: Column, second: Column, ratio: float = MIN_RATIO) -> Column:
    """Whether a winner is far enough ahead, in single precision; a distance of 0 always is."""
    share = (second - best).cast("float") / F.nullif(best, F.lit(0)).cast("float")
    return (best == 0) | (F.coalesce(share, F.lit(0)).cast("float") > F.lit(ratio).cast("float"))


def _matrix(bits: pa.ChunkedArray) -> np.ndarray:
    """Rows of bits, all of one length, as eight-byte words."""
    column = bits.combine_chunks()
    n, size = len(column), len(column[0].as_py())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    if (np.diff(offsets) != size).any():
        raise ValueError("rows of bits of different lengths")
    out = np.zeros((n, -(-size // 8) * 8), np.uint8)
    out[:, :size] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(n, size)
    return out.view(np.uint64)


def _odd_bits(rows: np.ndarray, usual: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) of the bits that differ from the usual row, some rows at a time, rows in order."""
    step = max(1, (1 << 25) // (64 * rows.shape[1]))
    for at in range(0, len(rows), step):
        row, byte = np.nonzero((rows[at : at + step] ^ usual).view(np.uint8))
        bits = np.unpackbits((rows[at : at + step] ^ usual).view(np.uint8)[row, byte][:, None], axis=1)
        i, bit = np.nonzero(bits)
        yield row[i] + at, byte[i] * 8 + bit


class _Postings:
    """Distances to all rows of a block, by the places where rows differ from most.

    Two rows differ where either differs from the usual one but not both: a query only meets the rows that are odd in one
    of its odd places. Made where that is less work than comparing all words.
    """

    def __init__(self, held: np.ndarray, usual: np.ndarray):
        self.usual, found = usual, [(r.astype(np.int32), p.astype(np.int32)) for r, p in _odd_bits(held, usual)]
        row, place = (np.concatenate(c) for c in zip(*found))
        self.n = np.bincount(row, minlength=len(held)).astype(np.int32)
        key = place.astype(np.int64) << 32 | row
        key.sort()
        self.row = (key & 0xFFFFFFFF).astype(np.intp)
        self.start = np.searchsorted(key, np.arange(64 * held.shape[1] + 1, dtype=np.int64) << 32)

    def distances(self, mine: np.ndarray) -> np.ndarray:
        _, place = next(_odd_bits(mine[None], self.usual))
        met = np.concatenate([self.row[:0], *(self.row[a:b] for a, b in zip(self.start[place].tolist(), self.start[place + 1].tolist()) if a < b)])
        return self.n + np.int32(len(place)) - 2 * np.bincount(met, minlength=len(self.n)).astype(np.int32)


def _sparse(held: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, int] | None:
    """The usual row, of zeros or ones, and how many rows' postings to make at once, where few bits of rows differ from it; else None."""
    seen = np.concatenate((held[:: max(1, len(held) // 1000)], asked[:: max(1, len(asked) // 1000)]))
    share = np.bitwise_count(seen).mean() / 64
    odd = min(share, 1 - share)
    if 64 * odd**2 >= 0.25:  # a posting is dearer than a word: expected ones of a row against its words
        return None
    return np.full(held.shape[1], 0 if share < 0.5 else 2**64 - 1, np.uint64), max(1, int(_POSTINGS / (1 + 64 * held.shape[1] * odd)))


def _block_best(key, queries: pa.Table, refs: pa.Table) -> pa.Table:
    """(query, block, dist, ref, before) of one pair of blocks: the first nearest reference, and the smallest distance before it."""
    out = []
    if queries.num_rows and refs.num_rows:
        refs = refs.sort_by("ref")
        ids, block, held = refs.column("ref").to_numpy(), refs.column("block")[0].as_py(), _matrix(refs.column("bits"))
        asked, names = _matrix(queries.column("bits")), queries.column("entity").to_pylist()
        sparse = _sparse(held, asked) if len(asked) > 8 else None
        step = sparse[1] if sparse else max(1, _AT_ONCE // held.shape[1])
        found = [(NO_SECOND, None, NO_SECOND)] * len(names)
        for at in range(0, len(ids), step):
            part, own = held[at : at + step], ids[at : at + step]
            postings = _Postings(part, sparse[0]) if sparse else None
            for k, (q, mine) in enumerate(zip(names, asked)):
                distance = postings.distances(mine) if postings else np.bitwise_count(part ^ mine).sum(axis=1, dtype=np.int32)
                distance[np.searchsorted(own, q) : np.searchsorted(own, q, "right")] = NO_SECOND  # never its own neighbour
                i = int(distance.argmin())
                best = found[k][0]
                if distance[i] < best:
                    found[k] = int(distance[i]), int(own[i]), min(best, int(distance[:i].min(initial=NO_SECOND)))
        out = [(q, block, best, ref, before) for q, (best, ref, before) in zip(names, found) if ref is not None]
    columns = list(zip(*out)) or [()] * 5
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "block", "dist", "ref", "before"])


def _size(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("bits"))).first()[0] or 0


def reference_blocks(references: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(ref, bits, block) of references (ref bigint, bits), written in the order of ref, a range of it a block of at most about block_bytes; null bits are left out."""
    rows = references.select("ref", "bits").filter("bits is not null")
    n = max(spread(references.sparkSession), -(-_size(rows) // block_bytes))
    return written(rows.repartitionByRange(n, "ref").withColumn("block", F.spark_partition_id().cast("bigint")), "references")


def nearest(queries: DataFrame, references: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query, ref, dist, second) for queries (entity bigint, bits) over references (ref bigint, bits), ordered by ref, or over reference_blocks.

    The earliest of the nearest wins. second is the smallest distance among the references before the winner, or
    NO_SECOND. A query that is itself a reference is not compared with itself; one without references has no row. Rows
    with null bits are left out. The queries should be a written table, as they are read more than once.
    """
    spark = queries.sparkSession
    queries = queries.select("entity", "bits").filter("bits is not null")
    n_q = max(1, -(-_size(queries) // block_bytes))
    blocks = references if "block" in references.columns else reference_blocks(references, block_bytes)
    n_r = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    tasks = min(n_q * n_r, TASKS)
    # every reference block meets every query block once: the stated query set against all rows
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    task = ((F.col("q_block") * n_r + F.col("block")) % tasks).cast("int").alias("task")
    asked = queries.withColumn("q_block", F.pmod(F.xxhash64("entity"), F.lit(n_q))).withColumn("block", every(n_r)).select(task, "q_block", "block", "entity", "bits")
    held = blocks.withColumn("q_block", every(n_q)).select(task, "q_block", "block", "ref", "bits")
    by = ["task", "q_block", "block"]
    best = asked.repartitionById(tasks, "task").groupBy(*by).cogroup(held.repartitionById(tasks, "task").groupBy(*by)).applyInArrow(_block_best, "query bigint, block bigint, dist bigint, ref bigint, before bigint")
    by_query = Window.partitionBy("query")  # one row a reference block
    first = best.withColumn("win", F.min(F.struct("dist", "ref", "block", "before")).over(by_query))
    earlier = F.min(F.when(F.col("block") < F.col("win.block"), F.col("dist")))
    out = first.groupBy("query").agg(F.first("win").alias("w"), F.coalesce(earlier, F.lit(NO_SECOND)).alias("e"))
    return out.select("query", F.col("w.ref").alias("ref"), F.col("w.dist").cast("int").alias("dist"), F.least("w.before", "e").cast("int").alias("second"))


def annotate(queries: DataFrame, references: DataFrame, labels: DataFrame, ratio: float = MIN_RATIO) -> DataFrame:
    """(query, ref, dist, second, species): the label of the winning reference, UNCLASSIFIED without an accepted one.

    labels (ref, species) may lack references and hold nulls; a query without any reference has null ref and distances.
    """
    found = nearest(queries, references)
    named = found.join(labels.dropDuplicates(["ref"]), "ref", "left")
    named = named.withColumn("species", F.when(accepted(F.col("dist"), F.col("second"), ratio), F.nullif("species", F.lit(""))))
    all_queries = queries.select(F.col("entity").alias("query")).distinct()
    return all_queries.join(named, "query", "left").select("query", "ref", "dist", "second", F.coalesce("species", F.lit("UNCLASSIFIED")).alias("species"))


def posting_index(sketches: DataFrame, max_posting: int = 1000) -> DataFrame:
    """(hash, entity) of sketches without the hashes that more than max_posting entities hold.

    Frequent hashes are found by a combined count first, so none of their groups is ever gathered.
    """
    frequent = sketches.groupBy("hash").count().filter(F.col("count") > max_posting).select("hash")
    return sketches.join(frequent, "hash", "left_anti").select("hash", "entity")


def index_info(index: DataFrame) -> DataFrame:
    return index.groupBy("hash").count().agg(F.count("*").alias("posting_groups"), F.coalesce(F.sum("count"), F.lit(0)).alias("kept_postings"), F.coalesce(F.max("count"), F.lit(0)).alias("largest_posting"))


def index_hits(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(query, ref, shared, query_size): shared hashes of each query with each other entity."""
    sizes = queries.groupBy("entity").agg(F.count("*").alias("query_size")).withColumnRenamed("entity", "query")
    asked = queries.select(F.col("entity").alias("query"), "hash")
    shared = asked.join(index.withColumnRenamed("entity", "ref"), "hash").filter("query <> ref").groupBy("query", "ref").agg(F.count("*").alias("shared"))
    return shared.join(sizes, "query")


def top_hits(hits: DataFrame, keep: int = 20, min_shared: int = 2) -> DataFrame:
    """Best refs of each query by share of its hashes, then shared hashes, then name; ties are broken by ref."""
    hits = hits.filter(F.col("shared") >= min_shared).withColumn("fraction", F.col("shared") / F.col("query_size"))
    by = Window.partitionBy("query").orderBy(F.desc("fraction"), F.desc("shared"), "ref")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= keep)


def best_estimates(scored: DataFrame, keep: int = 5) -> DataFrame:
    """The keep best refs of each query with their rank, by identity, then the aligned fractions of query and ref, then ref."""
    by = Window.partitionBy("query").orderBy(F.desc("ani"), F.desc("af_query"), F.desc("af_ref"), "ref")
    return scored.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= keep)


def rebind_labels(index_entities: DataFrame, labels: DataFrame) -> DataFrame:
    """labels (ref, species) for an index, refused unless they name exactly its entities, each once."""
    twice = labels.groupBy("ref").count().filter("count > 1").limit(1).count()
    odd = index_entities.select("ref").distinct().join(labels.select("ref", F.lit(1).alias("named")), "ref", "full_outer").filter("named is null").limit(1).count()
    extra = labels.select("ref").join(index_entities.select("ref"), "ref", "left_anti").limit(1).count()
    if twice or odd or extra:
        raise ValueError("the labels do not name exactly the references of the index")
    return labels
