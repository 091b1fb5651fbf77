import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from vacantia.llm import bpe, queries, registry

PATH, PATTERN = queries.RANKS, public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def packed(reference, text):
    ids = reference.encode_ordinary(text)
    return struct.pack(f"<{len(ids)}I", *ids)


def test_whole_table_agrees_with_a_public_encoder(spark, reference):
    rows = registry.QUERIES["op1_byte_bpe"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = packed(reference, texts[row.doc_id])
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_random_texts_agree_and_decode(reference):
    own, draw = bpe.codec(PATH, PATTERN), random.Random(3)
    signs = "ab 'sté\x1c\x85 　 中文\U0001f600'll1２½\n\t\r\x0b_-ʼaaathe"
    for _ in range(5_000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 60)))
        ids = own.encode(text)
        assert ids == packed(reference, text)
        assert own.decode(ids) == text.encode()


@pytest.mark.parametrize("piece", ["a", "ab", " ", "é", "0", "thethe"])
def test_very_long_pieces_take_linear_time(piece):
    own = bpe.codec(PATH, PATTERN)
    text = piece * 50_000
    assert own.decode(own.encode(text)) == text.encode()


def test_small_vocabulary_that_needs_steps_back():
    ranks = {bytes([b]): b for b in range(256)}
    for extra in (b"ab", b"bc", b"abc", b"cd", b"bcd", b"abcde", b"de"):
        ranks[extra] = len(ranks)
    own = bpe.Codec(ranks, r"\S+|\s+")
    plain = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    for _ in range(3_000):
        text = "".join(draw.choice("abcde") for _ in range(draw.randint(1, 12)))
        ids = plain.encode_ordinary(text)
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_nulls_empty_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, b"x"), (2, "", b"x"), (3, "a b", b"x"), (3, "a b", b"x"), (None, "c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).orderBy(F.asc_nulls_last("doc_id")).collect()
    assert [bytes(r.decoded).decode() for r in out] == ["", "", "a b", "a b", "c"]
    assert [len(r.ids) for r in out] == [0, 0, 8, 8, 4]
    assert out[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}
    assert bpe.encode(df.where("false"), PATH, PATTERN).count() == 0


def test_exact_is_what_comparing_the_decoded_bytes_says(spark):
    texts = ["one two", "", None, "naïve  \n🎉 12345", "one two", "x" * 5_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded", exact="exact")
    assert out.columns == ["doc_id", "text", "ids", "decoded", "exact"]
    for row in out.collect():
        assert row.exact is (bytes(row.decoded) == (row.text or "").encode()) is True
