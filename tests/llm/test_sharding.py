import zlib
from collections import Counter

from pyspark.sql import functions as F

from vacantia.llm import registry, sharding

SF = "/root/testdata/sf0.01"


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.QUERIES["op10_hash_tree"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and 30 <= len(slots) <= 100
    assert 30 <= sum(r.grown_shard == 16 for r in rows) <= 100


def placed(spark, tree, n=6_000):
    rows = sharding.assign(spark.range(n).withColumnRenamed("id", "doc_id"), tree)
    return {r.doc_id: r.shard for r in rows.collect()}


def test_draws_follow_weights_and_change_where_weights_change(spark):
    tree = [(0, 0, 0, 1.0), (0, 1, 1, 2.0), (1, 0, 2, 3.0), (1, 0, 3, 0.0), (2, 5, 9, 2.0)]
    before = placed(spark, tree)
    count = Counter(before.values())
    for _, _, shard, weight in tree:
        assert abs(count[shard] - 6_000 * weight / 8) < 200
    after = placed(spark, [(r, k, s, 4.0 if s == 9 else w) for r, k, s, w in tree])
    moved = {(before[i], after[i]) for i in before if before[i] != after[i]}
    assert moved and all(to == 9 for _, to in moved)
    inside = placed(spark, [(r, k, s, {0: 2.0, 1: 1.0}.get(s, w)) for r, k, s, w in tree])
    assert all({before[i], inside[i]} <= {0, 1} for i in before if before[i] != inside[i])


def test_every_added_shard_takes_rows_only_into_itself(spark):
    last = placed(spark, sharding.layout(5, planned=4), 2_000)
    for shards in range(6, 9):
        now = placed(spark, sharding.layout(shards, planned=4), 2_000)
        assert all(now[i] == shards - 1 for i in now if now[i] != last[i]) and now != last
        last = now


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "a", 1, "x")] * 500 + [(i, "b", 2, "y") for i in range(200)] + [(7, "b", 2, "y")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string").repartition(3)
    out = sharding.number(sharding.assign(df, sharding.layout(4, planned=4))).collect()
    assert len(out) == len(rows)
    assert len({r.shard for r in out if r.doc_id is None}) == 1
    for shard in range(4):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    empty = sharding.number(sharding.assign(df.where("false"), sharding.layout(2)))
    assert empty.count() == 0


def test_slots_need_no_row_order(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 5).cast("int").alias("shard"))
    one = sharding.number(df.repartition(7)).orderBy("doc_id").collect()
    assert one == sharding.number(df.coalesce(1)).orderBy("doc_id").collect()
