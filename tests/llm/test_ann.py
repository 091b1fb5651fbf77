import re

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows

from vacantia.llm import ann, registry

SF = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    found = set()
    for q, x in queries:
        near = sorted((-float(sum(a * b for a, b in zip(x, y))), v) for v, y in rows if v != q and len(x) == len(y))
        found |= {(q, rank + 1, v, -s) for rank, (s, v) in enumerate(near[:k])}
    return found


def got(df):
    return {tuple(r) for r in df.collect()}


def test_query_agrees_with_sql(spark):
    columns, rows = spark_rows(registry.QUERIES["op3_nearest"](spark, SF))
    assert (columns, rows) == sql_rows(connect(SF), registry.SQL["op3_nearest"])


def test_small_integers_with_ties_copies_and_several_bands(spark, monkeypatch):
    monkeypatch.setattr(ann, "SMALL_BAND", 40)
    monkeypatch.setattr(ann, "QUERY_BAND", 30)
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 8)]) for i in range(300)]
    rows += [(1_000 + i, rows[7][1]) for i in range(90)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = [r for r in rows if r[0] % 3 == 0]
    asked = spark.createDataFrame(queries, df.schema)
    assert got(ann.nearest(df, asked, k=5)) == brute(rows, queries, 5)


def test_bands_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BYTES", 40 * 8 * 64)
    monkeypatch.setattr(ann, "QUERY_BYTES", 10 * 8 * 64)
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.integers(-9, 10, 64)]) for i in range(400)]
    rows += [(1_000 + i, [float(x) for x in draw.integers(-9, 10, 3)]) for i in range(40)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 4 = 0")
    found = ann.nearest(df, asked, k=3)
    plan = found._jdf.queryExecution().analyzed().toString()
    held = [int(n) for n in re.findall(r"sequence\(0, (\d+),", plan)]
    assert sorted(held) == sorted([-(-asked.count() // 10) - 1, -(-len(rows) // 40) - 1])
    assert got(found) == brute(rows, [r for r in rows if r[0] % 4 == 0], 3)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, None]), (None, [9.0, 9.0]), (8, []), (9, [1.0, 1.0, 1.0]), (2, [0.25, 0.5]), (2, [0.5, 0.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = [(1, [1.0, 0.0]), (2, [0.25, 0.5]), (9, [1.0, 1.0, 1.0])]
    found = ann.nearest(df.selectExpr("*", "1 AS id", "'x' AS vec"), df, k=3)
    assert got(found) == brute(kept, kept, 3)
    assert ann.nearest(df.where("false"), df, k=3).count() == 0
    assert ann.nearest(df, df.where("false"), k=3).count() == 0


def test_bounds_never_lose_a_neighbour_on_close_vectors():
    draw = np.random.default_rng(6)
    centre = draw.normal(size=48)
    rows = centre + 1e-3 * draw.normal(size=(4_000, 48))
    ids = np.arange(len(rows))
    found = ann._nearest(ids, rows, ids[:40], rows[:40], 10)
    exact = rows[:40] @ rows.T
    exact[np.arange(40), np.arange(40)] = -np.inf
    want = {(q, v) for q in range(40) for v in np.argsort(-exact[q])[:10].tolist()}
    assert {(q, v) for q, v, _ in found} == want


@pytest.mark.parametrize("size, spread", [(1e20, 0), (1e100, 3), (1e-25, 0), (1e-120, 3), (1.0, 60)])
def test_components_of_any_size(size, spread):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(300, 8)) * size * 10.0 ** draw.integers(-spread, spread + 1, size=(300, 1))
    ids = np.arange(300)
    found = ann._nearest(ids, vectors, ids[:40], vectors[:40], 5)
    got = {q: [v for _, v in sorted((-s, v) for one, v, s in found if one == q)] for q in range(40)}
    for q in range(40):
        scores = np.zeros(300)
        for d in range(8):
            scores += vectors[:, d] * vectors[q, d]
        assert got[q] == sorted((v for v in range(300) if v != q), key=lambda v: (-scores[v], v))[:5]
