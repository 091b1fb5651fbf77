import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vacantia.llm import imatch, registry

SF = "/root/testdata/sf0.01"


def edited(rows):
    """Digest of each text whose second half comes from the next one, by descending id."""
    order, found = sorted(rows, reverse=True), {}
    for at, (doc_id, text) in enumerate(order):
        after, half = order[(at + 1) % len(order)][1], len(text) // 2
        found[doc_id] = hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    return found


def test_query_against_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = {r.doc_id: r for r in registry.QUERIES["op5_imatch"](spark, SF).collect()}
    assert {d: r.edited_sha256 for d, r in rows.items()} == edited(docs)
    assert all(rows[d].n_chars == len(t) for d, t in docs)
    prints = {}
    for doc_id, text in docs:
        assert prints.setdefault(text, rows[doc_id].fingerprint) == rows[doc_id].fingerprint
    mean = lambda name: sum(r[name] for r in rows.values()) / len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    assert mean("near_edited") > 0.08 and mean("near_next") < 0.02


def test_lexicon_is_the_band_of_document_frequency(spark):
    texts = [f"every rare{i} {'some' if i % 50 == 0 else 'x' * (i % 7 + 1)}" for i in range(1_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = imatch.lexicon(df)
    count = {w: sum(w in t.split() for t in texts) for t in texts for w in t.split()}
    for word, n in list(count.items())[:300]:
        bucket = spark.range(1).select(F.xxhash64(F.lit(word)).bitwiseAND(F.lit(imatch.BUCKETS - 1))).first()[0] if n > 1 or word == "rare7" else None
        if bucket is not None:
            assert bool(words[bucket // 64] >> (bucket % 64) & 1) == (2 <= n <= 100), word


@pytest.mark.parametrize("width", [1, 3, 7, 1_000])
def test_next_row_over_any_ranges(spark, monkeypatch, width):
    monkeypatch.setattr(imatch, "RANGE", width)
    draw = random.Random(width)
    ids = draw.sample(range(-500, 5_000), 211)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.next.text for r in imatch.with_next(df, "doc_id", ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: f"t{order[(n + 1) % len(order)]}" for n, i in enumerate(order)}


def test_next_row_of_repeated_missing_and_single_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.next.text) for r in imatch.with_next(df, "doc_id", ["text"]).collect())
    assert got == [(-1, "b"), (1, "n"), (2, "a"), (2, "b")]
    one = imatch.with_next(df.where("doc_id = 1"), "doc_id", ["text"]).first()
    assert one.next.text == "a"
    assert imatch.with_next(df.where("false"), "doc_id", ["text"]).count() == 0


def test_small_edits_leave_most_parts_equal(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(3_000)]
    texts = [" ".join(draw.choices(words, k=200)) for _ in range(150)]
    near = [t.replace(t.split()[5], "other") for t in texts]
    docs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(texts, near))], "doc_id long, text string, b string")
    lexicon = imatch.lexicon(docs)
    rows = imatch.fingerprint(imatch.fingerprint(docs, lexicon, "text", "x"), lexicon, "b", "y")
    assert rows.agg(F.avg(imatch.likeness("x", "y"))).first()[0] > 0.8


def test_nulls_empty_long_and_clashing_columns(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "wort " * 50_000, "k"), (4, "wort", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, own string")
    out = imatch.fingerprint(df, imatch.lexicon(df), "text", "own").orderBy("doc_id").collect()
    assert out[0].own == out[1].own and out[2].own == out[3].own and out[0].own != out[2].own
    assert set(out[0].asDict()) == {"doc_id", "text", "own"}
    assert imatch.fingerprint(df.where("false"), imatch.lexicon(df.where("false")), "text", "own").count() == 0
