import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import lm, registry
from vacantia.llm.eliasfano import EliasFano

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    """Every row scored from plain counts, with logarithms rounded as the levels hold them."""
    docs = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), h) for d, t, h in rows]
    one, two, three = Counter(), Counter(), Counter()
    for _, words, held in docs:
        if not held:
            seq = ["<s>", "<s>", *words, "</s>"]
            one.update(seq[2:])
            one["<s>"] += 1
            two.update(zip(seq[1:], seq[2:]))
            three.update(zip(seq, seq[1:], seq[2:]))
    texts = one.pop("<s>", 0)
    total, kinds = sum(one.values()), len(one)
    share = lambda w: (one[w] + 0.1) / (total + 0.1 * (kinds + 1))
    log = lambda x: round(math.log10(x) * 1024)
    out = []
    for doc_id, words, held in docs:
        seq, score, base = ["<s>", "<s>", *words, "</s>"], -log(texts + lm.WEIGHTS[1]), 0.0
        for u, v, w in zip(seq, seq[1:], seq[2:]):
            context = texts if v == "<s>" else one[v]
            after = (two[v, w] + lm.WEIGHTS[0] * share(w)) / (context + lm.WEIGHTS[0])
            score += log(three[u, v, w] + lm.WEIGHTS[1] * after)
            score -= log(two[v, w] + lm.WEIGHTS[1]) if w != "</s>" else 0
            base += math.log10(share(w))
        out.append((doc_id, held, len(words) + 1, sum(one[w] > 0 for w in seq[2:]), total, base, score / 1024))
    return out


def agree(df, rows):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[6], 3))
    got, want = sorted(map(tuple, df.collect()), key=key), sorted(brute(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=0, atol=0.003)  # a logarithm may lie on a border


def test_query_against_plain_counts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(d, t, zlib.crc32(str(d).encode()) % 10 == 0) for d, t in rows]
    out = registry.QUERIES["op12_lm"](spark, SF)
    agree(out, rows)
    held = [r for r in out.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # it predicts what it has not seen


@pytest.mark.parametrize("bundle, shard, part", [(1 << 21, 1 << 21, 1 << 20), (50, 40, 8), (7, 1 << 21, 1), (300, 5, 30)])
def test_any_sizes_of_bundles_shards_and_parts(spark, monkeypatch, bundle, shard, part):
    for name, value in (("BUNDLE_TOKENS", bundle), ("SHARD", shard), ("WORD_SHARD", shard), ("PART", part)):
        monkeypatch.setattr(lm, name, value)
    draw = random.Random(bundle)
    word = lambda: draw.choice(("the", "of", "the", "of", f"w{draw.randrange(40)}", "É", "THE"))
    rows = [(i, " ".join(word() for _ in range(draw.randint(0, 14))), draw.random() < 0.2) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    agree(lm.score(df, F.col("held")), rows)


def test_nulls_long_texts_repeated_rows_no_training_and_empty_tables(spark):
    long = " ".join(f"w{i * i % 7_001}" for i in range(60_000))
    rows = [(1, None, False), (2, "", False), (3, " \n\x0b", True), (4, "a b A", False), (4, "a b A", False), (None, "a b", False), (5, long, False), (6, "new words b", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").selectExpr("*", "1 AS bundle", "'x' AS shard")
    agree(lm.score(df, F.col("held")), rows)
    agree(lm.score(df, F.lit(None).cast("boolean")), [(d, t, True) for d, t, _ in rows])
    assert lm.score(df.where("false"), F.col("held")).count() == 0


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (1, 1 << 40), (1_000, 50), (1_000, 1 << 45), (3_000, 3_000)])
def test_elias_fano_against_plain_search(n, most):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, most, n))
    level = EliasFano(values)
    assert (level.get(np.arange(n)) == values).all()
    asked = np.concatenate([draw.integers(0, most + 5, 400), values[:400]])
    begin = draw.integers(0, n + 1, len(asked))
    end = np.minimum(n, begin + draw.integers(0, n + 1, len(asked)))
    place, equal = level.successor(asked, begin, end)
    for i, x in enumerate(asked):
        want = begin[i] + np.searchsorted(values[begin[i] : end[i]], x)
        assert place[i] == want and equal[i] == (want < end[i] and values[want] == x)


def test_packed_numbers_come_back():
    for values in ([], [0], [5, 1 << 62, 0], [-1, 7]):
        a = np.array(values, np.int64)
        assert [x.tolist() for x in lm.unpack(lm.pack(a, a[::-1]))] == [a.tolist(), a[::-1].tolist()]
