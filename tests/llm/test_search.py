import math
import random
import re
import string

import pytest
from compare import connect, spark_rows, sql_rows

from vacantia.llm import registry, search

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    split = [(d, terms(t)) for d, t in docs if terms(t)]
    n, total = len(split), sum(len(t) for _, t in split)
    df = {}
    for _, own in split:
        for term in set(own):
            df[term] = df.get(term, 0) + 1
    found = []
    for item, text in set(items):
        scores = []
        for doc_id, own in split:
            m = 25 + 75 * len(own) * n // total
            score = 0
            for term in terms(text):
                if tf := own.count(term):
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += weight * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k])]
    return sorted(map(repr, found))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_query_agrees_with_sql(spark):
    columns, rows = spark_rows(registry.QUERIES["op11_search"](spark, SF))
    assert (columns, rows) == sql_rows(connect(SF), registry.SQL["op11_search"])
    assert rows


@pytest.mark.parametrize("window, docs_in_block, long, round_terms, filtered", [(4_096, 1 << 16, 16, 1 << 20, True), (7, 40, 3, 5, True), (16, 1_000, 1_000_000, 1 << 20, False), (16, 100, 1, 30, True)])
def test_any_windows_blocks_rounds_and_kinds_of_lists(spark, monkeypatch, window, docs_in_block, long, round_terms, filtered):
    monkeypatch.setattr(search, "WINDOW", window)
    monkeypatch.setattr(search, "BLOCK_DOCS", docs_in_block)
    monkeypatch.setattr(search, "LONG", long)
    monkeypatch.setattr(search, "ROUND_TERMS", round_terms)
    if not filtered:
        monkeypatch.setattr("vacantia.llm.minhash.FILTER_MEMBERS", -1)
    draw = random.Random(window)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "the", "the", "the"]
    text = lambda n: " ".join(words[min(int(draw.expovariate(0.1)), len(words) - 1)] for _ in range(n))
    docs = [(i, text(draw.randint(1, 30))) for i in range(300)]
    docs += [(1_000 + i, docs[5][1]) for i in range(40)]  # ties
    items = [(i, text(draw.randint(1, 12))) for i in range(12)]
    frame = lambda rows, names: spark.createDataFrame(rows, names).repartition(3)
    out = search.best_documents(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    assert got(out) == brute(docs, items)


def test_nulls_empty_texts_long_texts_repeated_rows_and_clashing_columns(spark):
    long = " ".join(f"w{i % 900}" for i in range(50_000))
    docs = [(1, None), (2, ""), (3, " .,! "), (4, "Red fox"), (4, "red fox"), (4, "red fox"), (None, "red fox"), (5, long), (6, "blue-RED_fox3 fox")]
    items = [(1, "red fox"), (1, "red fox"), (1, "w7 fox"), (None, "blue"), (2, None), (3, ""), (4, "nowhere"), (5, long)]
    docs_frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS term", "1 AS score", "2 AS item")
    items_frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'t' AS terms")
    assert got(search.best_documents(docs_frame, items_frame)) == brute(docs, items)
    assert search.best_documents(docs_frame.where("false"), items_frame).count() == 0
    assert search.best_documents(docs_frame, items_frame.where("false")).count() == 0
