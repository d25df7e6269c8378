"""Encoding of whole texts with a public byte-level tokenizer, in overlapping chunks.

Long texts are cut into chunks that overlap. Chunks are pre-tokenised and their pieces encoded in parallel; two
neighbours are stitched at the first piece boundary that both found in the overlap, from where on the pre-tokenisation
is the same whichever chunk it started in. Where the overlap holds no common boundary (a single piece longer than
it), the chunks concerned are joined again and encoded as one. Decoding concatenates the raw bytes of the ids.

Defined results: null and empty texts have an empty list; text that looks like a special token is plain text; rows
delivered twice give one row; texts of any length are encoded whole; other columns are not read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, table

#: folder of the public vocabulary files; they are read where they lie
TOKENIZERS = os.environ.get("SEQLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# fixed values: the published pre-token pattern of the vocabulary
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK = 8192
OVERLAP = 512
#: boundaries so near a chunk's end could still change with what follows
MARGIN = 16

_held: dict = {}


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def encoding(path: str):
    """The tokenizer of a rank file, made once in a worker."""
    if path not in _held:
        import tiktoken

        _held[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})
    return _held[path]


def _pieces():
    if "pieces" not in _held:
        import regex

        _held["pieces"] = regex.compile(PATTERN)
    return _held["pieces"]


def _lists(values: list[list[int]]) -> pa.Array:
    offsets = [0]
    for v in values:
        offsets.append(offsets[-1] + len(v))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([x for v in values for x in v], pa.int32()))


def _encode_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([encode(t) if t else [] for t in part.column(1).to_pylist()])], names=["doc_id", "ids"])

    return run


def encode_chunk(text: str, first: bool, last: bool, overlap: int, encode) -> dict:
    """Ids of one chunk's pieces, with the boundaries in its overlaps (characters) and the ids before each."""
    # a boundary after white space is no cut: the piece before it would end otherwise if the text ended there
    bounds = [0, *(e for m in _pieces().finditer(text) if not text[(e := m.end()) - 1].isspace())]
    n = len(text)
    head = [] if first else [b for b in bounds if b <= overlap and b <= n - MARGIN]
    tail = [] if last else [b for b in bounds if n - overlap <= b <= n - MARGIN]
    cuts = sorted({0, n, *head, *tail})
    ids: list[int] = []
    before = {0: 0}
    for a, b in zip(cuts, cuts[1:]):
        ids += encode(text[a:b])
        before[b] = len(ids)
    return {"ids": ids, "head": head, "head_ids": [before[b] for b in head], "tail": tail, "tail_ids": [before[b] for b in tail]}


def stitch(chunks: list[dict], overlap: int, encode) -> list[int]:
    """Ids of the text of which these are the chunks, in order (text, ids, head, head_ids, tail, tail_ids)."""
    joints: list[tuple[int, int] | None] = []  # per pair of neighbours: place in the left and in the right chunk's lists
    for a, b in zip(chunks, chunks[1:]):
        shift = len(a["text"]) - overlap  # where the right chunk begins in the left one
        right = {x: j for j, x in enumerate(b["head"])}
        joints.append(next(((i, right[x - shift]) for i, x in enumerate(a["tail"]) if x - shift in right), None))
    out: list[int] = []
    at = 0
    while at < len(chunks):
        end = at
        while end < len(chunks) - 1 and joints[end] is None:
            end += 1
        into, onward = (joints[at - 1] if at else None), (joints[end] if end < len(chunks) - 1 else None)
        if end == at:
            c = chunks[at]
            out += c["ids"][c["head_ids"][into[1]] if into else 0 : c["tail_ids"][onward[0]] if onward else None]
        else:
            text = chunks[at]["text"] + "".join(c["text"][overlap:] for c in chunks[at + 1 : end + 1])
            stop = len(text) - len(chunks[end]["text"]) + chunks[end]["tail"][onward[0]] if onward else len(text)
            out += encode(text[chunks[at]["head"][into[1]] if into else 0 : stop])
        at = end + 1
    return out


_PARTS = "doc_id bigint, i int, text string, ids array<int>, head array<int>, head_ids array<int>, tail array<int>, tail_ids array<int>"


def _encode_chunks(path: str, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                doc, i, n, text = (part.column(k).to_pylist() for k in range(4))
                done = [encode_chunk(t, a == 0, a == b - 1, overlap, encode) for a, b, t in zip(i, n, text)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(i, pa.int32()), pa.array(text, pa.string()), *(_lists([d[k] for d in done]) for k in ("ids", "head", "head_ids", "tail", "tail_ids"))],
                    names=["doc_id", "i", "text", "ids", "head", "head_ids", "tail", "tail_ids"],
                )

    return run


def _stitched(path: str, overlap: int):
    def run(chunks: pa.Table) -> pa.Table:
        rows = sorted(chunks.to_pylist(), key=lambda r: r["i"])
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]], pa.int64()), "ids": _lists([stitch(rows, overlap, encoding(path).encode_ordinary)])})

    return run


def encode_documents(documents: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, ids array<int>) of documents (doc_id, text), one row a document."""
    if not 2 * MARGIN < overlap <= chunk // 2:
        raise ValueError("the overlap must be larger than the margins and at most half a chunk")
    path = os.path.join(folder, vocabulary)
    # one row a document; rows delivered again are dropped before the shuffle, and this shuffle spreads the encoding
    docs = documents.groupBy("doc_id").agg(F.first("text").alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap
    short = docs.filter(~long).mapInArrow(_encode_whole(path), "doc_id bigint, ids array<int>")
    n = F.ceil((F.length("text") - overlap) / chunk).cast("int")
    pieces = docs.filter(long).select("doc_id", n.alias("n"), F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("i"), F.substring("text", i * chunk + 1, F.lit(chunk + overlap)).alias("text")))).alias("c"))
    pieces = pieces.select("doc_id", "c.i", "n", "c.text").repartition(spread(documents.sparkSession), "doc_id", "i")
    stitched = pieces.mapInArrow(_encode_chunks(path, overlap), _PARTS).groupBy("doc_id").applyInArrow(_stitched(path, overlap), "doc_id bigint, ids array<int>")
    return short.unionByName(stitched)


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, content binary): the raw bytes of each list of ids."""
    path = os.path.join(folder, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _held.get((path, "bytes")) or _held.setdefault((path, "bytes"), {v: k for k, v in ranks(path).items()})
        for batch in batches:
            content = [b"".join(map(token.__getitem__, ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, content binary")


def p7_ids(spark, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents").select("doc_id", "text"))


def p7_decoded(spark, folder: str) -> DataFrame:
    """(doc_id, text) decoded from the ids; equals the text of every document, with '' for null."""
    return decode_documents(p7_ids(spark, folder)).select("doc_id", F.decode("content", "UTF-8").alias("text"))


def p7_chunked(spark, folder: str) -> DataFrame:
    """One row (n_documents, n_chunked, n_equal): documents encoded as usual and in chunks of 256 letters, and how many have the same ids in both."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    whole, parts = p7_ids(spark, folder), encode_documents(docs, 256, 64).withColumnRenamed("ids", "parts")
    sizes = docs.groupBy("doc_id").agg(F.coalesce(F.max(F.length("text")), F.lit(0)).alias("n"))
    met = whole.join(parts, "doc_id").join(sizes, "doc_id")
    return met.agg(F.count("*").alias("n_documents"), F.count_if(F.col("n") > 256 + 64).alias("n_chunked"), F.count_if(F.col("ids") == F.col("parts")).alias("n_equal"))


SQL = {
    "p7_chunked": "SELECT count(*) AS n_documents, count(*) FILTER (n > 320) AS n_chunked, count(*) AS n_equal FROM (SELECT doc_id, max(length(text)) AS n FROM documents GROUP BY 1)",
    "p7_decoded": "SELECT doc_id, coalesce(any_value(text), '') AS text FROM documents GROUP BY doc_id",
}
