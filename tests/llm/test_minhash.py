import random
import re
import string

import numpy as np
import pytest

from vacantia.llm import components as stars_and_rounds
from vacantia.llm import minhash, registry
from vacantia.llm.components import components

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def brute(rows):
    """Size, component and kept of every row, from all pairs."""
    sets, found = {d: shingle_set(t) for d, t in rows}, Union()
    ids = sorted(d for d in sets if sets[d])
    for at, a in enumerate(ids):
        for b in ids[:at]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                found.join(a, b)
    return {d: (len(sets[d]), found.root(d), found.root(d) == d) for d in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def copies(draw, base, most):
    """Near copies with up to ``most`` words exchanged."""
    words = base.split()
    for _ in range(draw.randint(0, most)):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert got(registry.QUERIES["op8_minhash"](spark, SF)) == want
    assert sum(not kept for *_, kept in want.values()) > 20


@pytest.mark.parametrize("block", [1_024, 16])
def test_groups_of_near_copies_and_shared_passages(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block * 400)
    draw = random.Random(block)
    word = lambda: draw.choice(("alpha", "beta", "gamma", "delta", "one", "two", "three")) + str(draw.randrange(400))
    base = " ".join(word() for _ in range(150))
    passage = " ".join(word() for _ in range(60))
    texts = [copies(draw, base, 4) for _ in range(120)]
    texts += [f"{passage} {' '.join(word() for _ in range(draw.randint(2, 30)))}" for _ in range(120)]
    texts += [base.upper()] * 3 + [" ".join(word() for _ in range(40)) for _ in range(60)]
    ids = draw.sample(range(-1_000, 9_000), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(minhash.near_duplicates(df)) == brute(rows)


def test_short_empty_null_very_long_and_repeated_rows(spark):
    long = " ".join(f"w{i % 9_000}" for i in range(60_000))
    rows = [
        (5, "a b c"), (4, "A\x0bB\tc"), (9, "a b"), (3, ""), (2, None), (1, " \n"), (8, long), (7, long + " end"),
        (6, "é b c"), (10, "É b c"), (None, "a b c"), (11, "x y z"), (11, "x y z"), (0, "\x1ca b c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'n' AS node", "1 AS id", "2 AS size")
    out = sorted(minhash.near_duplicates(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert len(out) == len(rows)
    want = brute([r for r in rows if r[0] is not None])
    assert all((r.n_shingles, r.component_id, r.kept) == want[r.doc_id] for r in out if r.doc_id is not None)
    assert tuple(out[-1]) == (None, 1, None, True)
    assert minhash.near_duplicates(df.where("false")).count() == 0


def test_rows_of_one_id_with_other_texts_are_linked_by_their_own(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(5, base), (5, "something else that is long enough"), (3, base + " end"), (2, "something else that is long enough")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert found == [(2, 2, 2, True), (3, 97, 3, True), (5, 2, 2, False), (5, 96, 3, False)]


def test_signatures_estimate_likeness():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 1 << 63, 2_000, dtype=np.uint64)
    agree = [
        (minhash.signature(pool[:n]) == minhash.signature(pool[: n + 150])).mean() for n in range(850, 1_850, 20)
    ]
    exact = [n / (n + 150) for n in range(850, 1_850, 20)]
    assert abs(np.mean(agree) - np.mean(exact)) < 0.02


@pytest.mark.parametrize("held", [stars_and_rounds.TASK_LINKS, 100, 7])  # in one task, and in rounds over all
@pytest.mark.parametrize("nodes, links", [(400, 300), (300, 600), (50, 0)])
def test_components_of_random_links(spark, monkeypatch, nodes, links, held):
    monkeypatch.setattr(stars_and_rounds, "TASK_LINKS", held)
    draw, found = random.Random(nodes), Union()
    rows = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(links)]
    rows += [(i, i + 1) for i in range(1_000, 1_090)] + [(2_000, i) for i in range(2_001, 2_400)] + [(7, None)]
    for a, b in rows:
        if b is not None:
            found.join(a, b)
    df = spark.createDataFrame(rows, "a long, b long").repartition(4)
    want = {x: found.root(x) for x in list(found) if found.root(x) != x}
    assert {r.node: r.root for r in components(df).collect()} == want
    assert components(df.where("false")).count() == 0
    names = df.selectExpr("concat('é', hex(a)) AS a", "concat('é', hex(b)) AS b")
    by_name = Union()
    for x, root in want.items():
        by_name.join(f"é{x:X}", f"é{root:X}")
    assert {r.node: r.root for r in components(names).collect()} == {n: by_name.root(n) for n in list(by_name) if by_name.root(n) != n}


def test_components_with_batches_of_a_few_rows(spark, monkeypatch):
    monkeypatch.setattr(stars_and_rounds, "TASK_LINKS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)
    try:
        df = spark.range(0, 300, 1, 3).selectExpr("id AS a", "id + 1 AS b")
        assert {(r.node, r.root) for r in components(df.union(df)).collect()} == {(i, 0) for i in range(1, 301)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
