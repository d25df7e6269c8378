import random

import pyarrow.parquet as pq
import pytest

from seqloom.llm import tokens

DATA = "/root/testdata/sf0.001"


def plain():
    return tokens.encoding(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}").encode_ordinary


TEXTS = [
    None,
    "",
    " ",
    "\n\n\nb  c \t\r\n d",
    "<|endoftext|> is plain text",
    "a" * 900,
    "ACGT" * 400 + " end",
    " \n" * 500 + "x",
    "Ein kurzer Text. " * 80,
    "日本語の文章です。" * 90,
    "it's we'll they're 'sd don't " * 60,
    "é\U0001f9ec‍ " * 150,
]


def test_chunks_equal_whole_texts(spark):
    rng = random.Random(5)
    parts = ["word", " ", "  ", "\n\n", "'s", "12", "ß", "日本", ".", "\t", "é", "<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows + rows[:9], "doc_id bigint, text string").selectExpr("*", "'x' as i", "1 as n", "text as ids")
    for chunk, overlap in ((100, 40), (257, 64), (8192, 512)):
        got = {r.doc_id: list(r.ids) for r in tokens.encode_documents(df, chunk, overlap).collect()}
        assert got == {i: plain()(t) if t else [] for i, t in rows}


def test_same_as_another_library_and_back(spark):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    encoded = tokens.p7_ids(spark, DATA).cache()
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert got == {d: other.encode(t or "", add_special_tokens=False).ids for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    back = {r.doc_id: bytes(r.content).decode() for r in tokens.decode_documents(encoded).collect()}
    assert back == {d: t or "" for d, t in zip(docs["doc_id"], docs["text"], strict=True)}


def test_empty_table(spark):
    assert tokens.encode_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
