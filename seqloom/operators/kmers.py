"""k-mer streams of sequences, their hashes and sketches.

Sequences are scanned in Arrow batches: bases become two-bit numbers, and the words of all windows of a batch are
built at once by doubling. A window with anything but A, C, G or T in it gives no word. The smaller of a word and its
reverse complement stands for both, which is the order of the letters too.

Defined results: null, empty and short sequences give nothing; records of one entity add up; repeated rows must be
dropped by the caller where they are not meant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_CODE = np.full(256, 4, np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i
_CODE[ord("U")] = _CODE[ord("u")] = 3
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: letters whose words are held at once
PIECE = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """The published SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    keep = _LETTER[data]
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets - offsets[0]]


def _words(digits: np.ndarray, k: int, forward: bool) -> np.ndarray:
    """Two-bit words of all windows of k; backward ones have the first letter lowest."""
    out, width, at = None, 0, digits.astype(np.uint64)
    step, size = k, 1
    while step:
        n = len(digits) - k + 1
        if step & 1:
            part = at[width : width + n]
            if out is None:
                out = part.copy()
            elif forward:
                out = (out << np.uint64(2 * size)) | part
            else:
                out = out | (part << np.uint64(2 * width))
            width += size
        step >>= 1
        if step:
            a, b = at[:-size], at[size:]
            at = ((a << np.uint64(2 * size)) | b) if forward else (a | (b << np.uint64(2 * size)))
            size *= 2
    return out


def canonical_words(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, word) of every valid window of k letters within a row; place counts letters."""
    letters, offsets = _letters(column)
    if len(letters) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code = _CODE[letters]
    bad = np.concatenate(([0], np.cumsum(code > 3)))
    digits = np.minimum(code, 3)
    n = len(letters) - k + 1
    start = np.arange(n)
    row = np.searchsorted(offsets, start, side="right") - 1
    good = (bad[k:] == bad[:-k]) & (start + k <= offsets[row + 1])
    word = np.minimum(_words(digits, k, True), _words(3 - digits, k, False))
    return row[good], (start - offsets[row])[good], word[good]


def kmer_rows(records: DataFrame, k: int, hashed: bool = False, at_most: int | None = None) -> DataFrame:
    """(entity, pos, word) of records (entity, seq); words as hashes where asked, and of these only the smallest share.

    at_most is compared as an unsigned number.
    """
    kind = records.schema["entity"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, word = canonical_words(batch.column(1), k)
            if hashed:
                word = mix64(word)
            if at_most is not None:
                low = word <= np.uint64(at_most)
                row, pos, word = row[low], pos[low], word[low]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(pos.astype(np.int32)), pa.array(word.view(np.int64))], names=["entity", "pos", "word"])

    return records.select("entity", "seq").mapInArrow(run, f"entity {kind.simpleString()}, pos int, word bigint")


def kmer_counts(records: DataFrame, k: int) -> DataFrame:
    """(word, n) over all records; every batch counts its words first, so a shuffle carries at most 4^k rows a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.unique(canonical_words(batch.column(0), k)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return records.select("seq").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_letters(word, k: int):
    """Letters of a two-bit word."""
    digits = [F.element_at(F.array(*map(F.lit, "ACGT")), F.shiftright(word, 2 * (k - 1 - i)).bitwiseAND(F.lit(3)).cast("int") + 1) for i in range(k)]
    return F.concat(*digits)


def scaled_sketch(records: DataFrame, k: int = 15, scale: int = 64, cap: int | None = None) -> DataFrame:
    """(entity, hash): distinct word hashes in the smallest 1/scale of the range, the cap smallest of each entity if given.

    Hashes are filtered where they are made; only the sketch is shuffled. With scale >= 2 they fit a signed number.
    """
    rows = kmer_rows(records, k, True, ((1 << 64) - 1) // scale).select("entity", F.col("word").alias("hash")).distinct()
    if cap is None:
        return rows
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("entity").orderBy("hash"))).filter(F.col("r") <= cap).drop("r")


def seed_table(records: DataFrame, k: int = 15, most: int = 64, sample: int = 1) -> DataFrame:
    """(entity, pos, seed) without seeds that occur more than most times in their entity; one in sample by hash."""
    rows = kmer_rows(records, k).withColumnRenamed("word", "seed")
    if sample > 1:
        rows = rows.filter(F.pmod(F.xxhash64("seed"), F.lit(sample)) == 0)
    frequent = rows.groupBy("entity", "seed").count().filter(F.col("count") > most).select("entity", "seed")
    return rows.join(frequent, ["entity", "seed"], "left_anti")


def _cut(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(start, number) of runs of rows with about size bytes each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, stop - start
        start = stop


def _slot_votes(row: np.ndarray, h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, vote) in the order of rows and slots: sums of the votes of hashes."""
    key = (row * bits + ((h & np.uint64((1 << 63) - 1)) % np.uint64(bits)).astype(np.int64)) << 1 | (h >> np.uint64(63)).astype(np.int64)
    key.sort()
    own = key >> 1
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(own)))
    ups = np.add.reduceat(key & 1, first) if len(own) else n
    return own[first] // bits, (own[first] % bits).astype(np.int32), (2 * ups - n).astype(np.int32)


def _batch_votes(batch: pa.RecordBatch, hashes, bits: int, size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(entities, row, slot, vote) of runs of records (entity, seq) of about size letters; records of one entity in a run are added, a record is never in two.

    hashes gives (row, hash) of a column of sequences piece by piece, so that a long record needs no more memory.
    """
    for start, n in _cut(batch.column(1), size):
        entity = batch.column(0).slice(start, n).dictionary_encode()
        own = entity.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = [_slot_votes(own[row], h, bits) for row, h in hashes(batch.column(1).slice(start, n))]
        row, slot, vote = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), *np.zeros((2, 0), np.int32))
        if len(parts) > 1:
            key, at = np.unique(row * bits + slot, return_inverse=True)
            row, slot, vote = key // bits, (key % bits).astype(np.int32), np.bincount(at, weights=vote, minlength=len(key)).astype(np.int32)
        yield entity.dictionary, row, slot, vote


def _voted(records: DataFrame, hashes, bits: int, finish, schema: str, size: int = PIECE) -> DataFrame:
    """What finish makes, as columns of the schema, of each of the runs of _batch_votes."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _batch_votes(batch, hashes, bits, size):
                yield pa.RecordBatch.from_arrays(finish(*found), names=names)

    return records.filter("entity is not null").select("entity", "seq").mapInArrow(run, schema)


def vote_parts(records: DataFrame, hashes, bits: int) -> DataFrame:
    """(entity, votes) of records (entity, seq): what one run's hashes of an entity add up to, as its slots and then their votes in four bytes each; hashes gives (row, hash) of a column of sequences."""

    def finish(entity, row, slot, vote):
        held, first = np.unique(row, return_index=True)
        both = np.stack((slot, vote))
        packed = [both[:, a:b].tobytes() for a, b in zip(first, np.append(first, len(row))[1:])]
        return [entity.take(pa.array(held)), pa.array(packed, pa.binary())]

    return _voted(records, hashes, bits, finish, f"entity {records.schema['entity'].dataType.simpleString()}, votes binary")


def added_votes(parts: DataFrame) -> DataFrame:
    """(entity, slot, vote) of vote_parts: sums over all parts of an entity."""
    kind = parts.schema["entity"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in _cut(batch.column(1), 8 * PIECE):
                both = [np.frombuffer(v, np.int32).reshape(2, -1) for v in batch.column(1).slice(start, n).to_pylist()]
                row = np.repeat(np.arange(start, start + n), [v.shape[1] for v in both])
                slot, vote = np.concatenate([np.zeros((2, 0), np.int32), *both], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(slot), pa.array(vote.astype(np.int64))], names=["entity", "slot", "vote"])

    rows = parts.select("entity", "votes").mapInArrow(run, f"entity {kind.simpleString()}, slot int, vote bigint")
    return rows.groupBy("entity", "slot").agg(F.sum("vote").alias("vote"))


def _apart(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written records (entity, seq) of entities that have one, whose votes need no adding up, and of those that have more."""
    if not hasattr(records, "_written_at"):
        records = written(records.filter("entity is not null").select("entity", "seq"), "records")
    several = records.groupBy("entity").agg(F.count("*").alias("n")).filter("n > 1").select("entity")
    return records.join(several, "entity", "left_anti"), records.join(several, "entity", "left_semi")


def _word_hashes(k: int):
    def hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        row, _, word = canonical_words(column, k)
        yield row, mix64(word)

    return hashes


def sketch_votes(records: DataFrame, bits: int, k: int) -> DataFrame:
    """(entity, slot, vote): each word votes +1 or -1, by its hash's top bit, on the slot its other bits name.

    Votes are added within each batch before they are shuffled. Slots without votes are left out, as is a null entity.
    """
    return added_votes(vote_parts(records, _word_hashes(k), bits))


# fixed values: the first two default secrets of the published wyhash
_SECRET = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def _product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and high half of the 128-bit products."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    mid = a1 * b0 + ((a0 * b0) >> half)
    cross = a0 * b1 + (mid & low)
    return a * b, a1 * b1 + (mid >> half) + (cross >> half)


def wyhash17(data: np.ndarray) -> np.ndarray:
    """wyhash with seed 0 of every window of 17 bytes."""
    n = len(data) - 16
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = data.astype(np.uint64)
    for size in (1, 2, 4):
        eight = eight[:-size] | (eight[size:] << np.uint64(8 * size))
    s0, s1 = (np.array([s], np.uint64) for s in _SECRET)
    low, high = _product(s0, s1)
    low, high = _product(eight[:n] ^ s1, eight[8 : 8 + n] ^ low ^ high)
    low, high = _product(eight[1 : 1 + n] ^ s1, eight[9 : 9 + n] ^ low ^ high)
    low, high = _product(low ^ s0 ^ np.uint64(17), high ^ s1)
    return low ^ high


_OTHER_STRAND = np.full(256, ord("N"), np.uint8)
for _a, _b in ("AT", "TA", "GC", "CG"):
    _OTHER_STRAND[ord(_a)] = ord(_b)


def _archived_hashes(column: pa.Array, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    seqs = [s.encode()[:-1] if s is not None and len(s) > 17 else b"" for s in column.to_pylist()]
    ends = np.cumsum([0, *map(len, seqs)])
    whole = np.frombuffer(b"".join(seqs), np.uint8)
    for start in range(0, max(1, len(whole) - 16), size):
        data = whole[start : start + size + 16]  # each window is in one piece
        at = np.searchsorted(ends, np.arange(start, start + len(data) - 16), side="right") - 1
        inside = np.arange(start, start + len(at)) + 17 <= ends[at + 1]
        yield at[inside], wyhash17(data)[inside]
        yield at[inside], wyhash17(_OTHER_STRAND[data[::-1]])[::-1][inside]  # the other strand has windows in reverse order


def archived_votes(records: DataFrame, bits: int = 55_296) -> DataFrame:
    """(entity, slot, vote) as stored reference sketches were made: raw 17-byte windows of both strands, hashed by wyhash.

    A record of up to 17 letters has no window; the last letter of a record is in none, and on the other strand every
    letter but an upper-case base is N. Only votes of entities with several records are shuffled.
    """
    one, more = _apart(records)
    rows = _voted(one, _archived_hashes, bits, lambda entity, row, slot, vote: [entity.take(pa.array(row)), pa.array(slot), pa.array(vote.astype(np.int64))], f"entity {records.schema['entity'].dataType.simpleString()}, slot int, vote bigint")
    return rows.unionByName(added_votes(vote_parts(more, _archived_hashes, bits)))


def archived_sums(records: DataFrame, bits: int = 55_296) -> DataFrame:
    """(entity, n_slots, n_below, weighed) over archived_votes: slots, those with a vote below 0, and votes times the slot's number from 1; summed where they are made for an entity with one record."""

    def finish(entity, row, slot, vote):
        held, first, n = np.unique(row, return_index=True, return_counts=True)
        sums = [n, *(np.add.reduceat(v, first) if len(first) else n for v in ((vote < 0).astype(np.int64), (slot.astype(np.int64) + 1) * vote))]
        return [entity.take(pa.array(held)), *(pa.array(v.astype(np.int64)) for v in sums)]

    one, more = _apart(records)
    sums = _voted(one, _archived_hashes, bits, finish, f"entity {records.schema['entity'].dataType.simpleString()}, n_slots bigint, n_below bigint, weighed bigint")
    votes = added_votes(vote_parts(more, _archived_hashes, bits))
    return sums.unionByName(votes.groupBy("entity").agg(F.count("*").alias("n_slots"), F.count_if(F.col("vote") < 0).alias("n_below"), F.sum((F.col("slot") + 1) * F.col("vote")).alias("weighed")))


def packed_bits(records: DataFrame, hashes, bits: int, words: bool = False, every: bool = False) -> DataFrame:
    """(entity, bits binary) of records (entity, seq): bit i is 1 where slot i's votes do not sum below 0, from the top of each byte.

    With words, the bytes of every 64 bits are stored lowest first; with every, entities without votes have all bits set,
    without it no row. An entity with one record is packed where its votes
    are made; the votes of others are added up by slot, so that no task has all records of an entity.
    """

    def pack(entity, on):
        data = np.packbits(on, axis=1)
        data = data.reshape(len(on), -1, 8)[:, :, ::-1].reshape(len(on), -1) if words else data
        return [entity, pa.array([r.tobytes() for r in data], pa.binary())]

    def finish(entity, row, slot, vote):
        held, own = (np.arange(len(entity)), row) if every else np.unique(row, return_inverse=True)
        on = np.ones((len(held), bits), np.uint8)
        on[own[vote < 0], slot[vote < 0]] = 0
        return pack(entity.take(pa.array(held)), on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                entity, below = batch.slice(start, 512).columns
                on = np.ones((len(entity), bits), np.uint8)
                for row, listed in zip(on, below):
                    row[listed.values.to_numpy()] = 0
                yield pa.RecordBatch.from_arrays(pack(entity, on), names=["entity", "bits"])

    kind = f"entity {records.schema['entity'].dataType.simpleString()}, bits binary"
    one, more = _apart(records)
    added = added_votes(vote_parts(more, hashes, bits)).groupBy("entity").agg(F.collect_list(F.when(F.col("vote") < 0, F.col("slot"))).alias("below"))  # at most bits slots
    if every:
        added = more.select("entity").distinct().join(added, "entity", "left").select("entity", F.coalesce("below", F.array().cast("array<int>")).alias("below"))
    return _voted(one, hashes, bits, finish, kind, PIECE // 4).unionByName(added.mapInArrow(run, kind))


def bit_sketch(records: DataFrame, bits: int = 55_296, k: int = 17) -> DataFrame:
    """(entity, bits binary) by hashed canonical words; entities without words have no row."""
    return packed_bits(records, _word_hashes(k), bits)


def archived_sketch(records: DataFrame) -> DataFrame:
    """(entity, bits binary) of 6,912 bytes, equal to stored reference sketches; entities without windows have all bits set."""
    return packed_bits(records, _archived_hashes, 55_296, words=True, every=True)


def strand_words(column: pa.Array, k: int, both: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, word, reverse) of valid windows as they stand, and with both also those of the reverse complement, with places in it."""
    letters, offsets = _letters(column)
    if len(letters) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    code = _CODE[letters]
    bad = np.concatenate(([0], np.cumsum(code > 3)))
    digits = np.minimum(code, 3)
    start = np.arange(len(letters) - k + 1)
    row = np.searchsorted(offsets, start, side="right") - 1
    good = (bad[k:] == bad[:-k]) & (start + k <= offsets[row + 1])
    row, pos = row[good], (start - offsets[row])[good]
    word = _words(digits, k, True)[good]
    if not both:
        return row, pos, word, np.zeros(len(row), bool)
    back = np.diff(offsets)[row] - k - pos
    return np.tile(row, 2), np.concatenate((pos, back)), np.concatenate((word, _words(3 - digits, k, False)[good])), np.repeat([False, True], len(row))


def strand_rows(records: DataFrame, k: int, both: bool) -> DataFrame:
    """(entity, part, pos, word, rev) of records (entity, part, seq), by strand_words."""
    kind = records.schema["entity"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, word, rev = strand_words(batch.column(2), k, both)
            took = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(took), batch.column(1).take(took), pa.array(pos.astype(np.int32)), pa.array(word.view(np.int64)), pa.array(rev)], names=["entity", "part", "pos", "word", "rev"])

    return records.select("entity", F.col("part").cast("int"), "seq").mapInArrow(run, f"entity {kind}, part int, pos int, word bigint, rev boolean")
