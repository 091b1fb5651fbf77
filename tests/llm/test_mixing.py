import random
import re

import pytest
from pyspark.sql import functions as F

from vacantia.llm import mixing, registry

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights, most=3.0):
    """Shares by raising a common level until all words are given."""
    low, high = 0.0, most * sum(sizes) / min(weights) + 1
    for _ in range(200):
        level = (low + high) / 2
        given = [min(most * s, level * w) for s, w in zip(sizes, weights)]
        low, high = (level, high) if sum(given) < sum(sizes) else (low, level)
    return given


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.QUERIES["op9_mixing"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, registry.QUERIES["op9_mixing"](spark, SF).collect()))
    sizes, taken, largest, targets = {}, {}, {}, {}
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text))
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        largest[source] = max(largest.get(source, 0), r.size)
        targets[source] = r.target
    names = sorted(sizes)
    want = plain_targets([sizes[s] for s in names], [[5, 2, 1][i % 3] for i in range(len(names))])
    for name, target in zip(names, want):
        assert targets[name] == pytest.approx(target)
        assert abs(taken[name] - target) <= largest[name]


def test_excess_is_shared_until_none_is_above():
    draw = random.Random(9)
    for _ in range(200):
        sizes = [draw.randint(0, 10 ** draw.randint(0, 6)) for _ in range(draw.randint(1, 9))]
        weights = [[5.0, 2.0, 1.0][i % 3] for i in range(len(sizes))]
        given = mixing.Shares(weights, sizes, 3.0).targets()
        assert sum(given) == pytest.approx(sum(sizes))
        assert given == pytest.approx(plain_targets(sizes, weights), rel=1e-6, abs=1e-3)


def test_what_the_driver_holds_needs_no_python_workers(spark):
    rows = [("a", 3), ("b", 5), (None, 2), ("ü", 0)]
    docs = spark.createDataFrame([(s, n) for s, n in rows], "source string, size long")
    for sizes in (docs, docs.limit(0)):
        plan, few = mixing._plan(sizes, [5, 2, 1], 3.0)
        shown = plan._jdf.queryExecution().optimizedPlan().toString()
        assert few and "RDD" not in shown and "LocalRelation" in shown
        assert plan.dtypes[:3] == [("source", "string"), ("target", "double"), ("source_size", "bigint")]
        assert {(r.source, r.source_size) for r in plan.collect()} == {tuple(r) for r in sizes.collect()}


def test_hot_source_heavier_weights_come_more_often(spark):
    rows = [(i, "w " * (i % 9 + 1), "a" if i % 3 else "b", 4.0 if i % 2 else 1.0) for i in range(6_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double").repartition(6)
    out = mixing.mix(df, weights=[1, 5], quality=F.col("w")).collect()
    part = [r for r in out if r.source == "a"]
    assert abs(sum(r.taken for r in part) - part[0].target) <= 9
    share = lambda w: sum(r.taken > 0 for r in part if r.w == w) / sum(r.w == w for r in part)
    assert share(4.0) > 1.5 * share(1.0)
    full = [r for r in out if r.source == "b"]
    assert all(r.epochs <= r.times <= r.epochs + 1 for r in full) and full[0].epochs >= 1


def test_nulls_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None, "a", 7), (2, "x y", None, 7), (2, "x y", None, 7), (None, "z", "é", 7), (3, "", "a", 7), (4, "p q r", "b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mixing.mix(df, weights=[5, 2, 1]).collect()
    assert len(out) == len(rows)
    target = {r.source: r.target for r in out}
    assert target["a"] == 0 and sum(target.values()) == pytest.approx(8)
    for name, given in target.items():
        own = [r for r in out if r.source == name]
        assert abs(sum(r.taken for r in own) - given) <= max(r.size for r in own) / 2 + 1e-9
    assert mixing.mix(df.where("false"), weights=[1]).count() == 0


@pytest.mark.parametrize("bound", [100_000, 3])
def test_any_number_of_sources(spark, monkeypatch, bound):
    monkeypatch.setattr(mixing, "SOURCES", bound)  # with 3, targets and cuts are joins
    draw = random.Random(bound)
    names = [f"s{i:02}" for i in range(17)] + ["É", "日本", None]
    rows = [(i, "w " * draw.randint(0, 12), draw.choice(names[:4] if draw.random() < 0.5 else names)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix(df, weights=[5, 2, 1]).collect()
    assert len(out) == len(rows)
    order = sorted({r[2] for r in rows}, key=lambda n: (n is None, (n or "").encode()))
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in order]
    want = dict(zip(order, plain_targets(sizes, [[5, 2, 1][i % 3] for i in range(len(order))])))
    for name in order:
        own = [r for r in out if r.source == name]
        assert all(r.target == pytest.approx(want[name], rel=1e-6, abs=1e-3) for r in own)
        assert abs(sum(r.taken for r in own) - want[name]) <= 6.01  # half the longest text


def test_equal_rows_without_ids_come_near_their_target(spark):
    rows = [(None, "the same words", "x")] * 100 + [(i, f"ordinary words {i}", "y") for i in range(100)]
    rows += [(5, "said often", "z")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    out = mixing.mix(df, weights=[5, 2, 1]).collect()
    assert len(out) == len(rows)
    for name in "xyz":
        own = [r for r in out if r.source == name]
        assert sorted((r.doc_id or -1, r.text) for r in own) == sorted((d or -1, t) for d, t, s in rows if s == name)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1.5
        assert max(r.taken for r in own) <= 3 * own[0].size
    again = mixing.mix(df.repartition(3), weights=[5, 2, 1]).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
