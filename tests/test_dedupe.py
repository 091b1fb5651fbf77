import json

from pyspark.sql import functions as F

from vacantia.operators.dedupe import first_seen, only_new
from vacantia.operators.details import list_detail
from vacantia.operators.listings import explode_listings
from vacantia.operators.outcomes import outcomes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=30_000):
    """Ids where one holds a third of all rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(n, numPartitions=8).select(
        F.lit("s").alias("source"), key.alias("job_id"), F.col("id").alias("pos"),
        F.repeat(F.lit("x"), 200).alias("body"),
    )


def test_first_seen(spark):
    rows = [("s", "a", 2, 0, "later"), ("s", "a", 1, 9, "first"), ("t", "a", 3, 0, "other source"),
            ("s", None, 1, 1, "null id"), ("s", None, 1, 2, "null id again"), ("s", "b", None, 1, "b")]
    df = spark.createDataFrame(rows, "source string, job_id string, term int, pos int, x string")
    got = first_seen(df, ["source", "job_id"], ["term", "pos"], copies="n")
    assert got.columns == [*df.columns, "n"]
    assert sorted((r.source, r.job_id or "", r.x, r.n) for r in got.collect()) == [
        ("s", "", "null id", 2), ("s", "a", "first", 2), ("s", "b", "b", 1),
        ("t", "a", "other source", 1)]
    assert "n" not in first_seen(df, ["source", "job_id"], ["term", "pos"]).columns


def test_first_seen_reduces_a_hot_key_before_the_shuffle(spark):
    df = hot(spark)
    first = first_seen(df, ["source", "job_id"], ["pos"])
    rows = {r.job_id: r.pos for r in first.filter("job_id in ('hot', 'k1')").collect()}
    assert rows == {"hot": 0, "k1": 1}
    assert first.count() == 20_001
    plan = plan_of(first)
    assert plan.count("partial_min_by") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan


def test_only_new(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a"), ("s", None), ("s", "b")],
                               "source string, job_id string")
    seen = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None)], df.schema)
    want = [("s", ""), ("s", "b"), ("s", "b"), ("t", "a")]
    assert sorted((r[0], r[1] or "") for r in only_new(df, seen).collect()) == want
    unique = df.distinct()
    got = only_new(unique, seen, one_per_key=True)
    assert sorted((r[0], r[1] or "") for r in got.collect()) == sorted(set(want))


def skewed(spark, df):
    """Run with low limits, so that this small data counts as skewed; the plan that ran."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, x in settings.items():
            spark.conf.set(k, x)
        made = df()
        n = made._jdf.queryExecution().toRdd().count()
        return n, plan_of(made)
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def test_only_new_splits_a_hot_key(spark):
    seen = spark.range(1, 30_000, 2).select(
        F.lit("s").alias("source"), F.concat(F.lit("k"), F.col("id")).alias("job_id"))
    n, plan = skewed(spark, lambda: only_new(hot(spark), seen))
    assert n == 10_000 + 10_000
    assert "skew=true" in plan


def test_list_detail_splits_a_hot_key(spark):
    details = hot(spark).select("job_id").distinct().withColumn("d", F.upper("job_id"))
    n, plan = skewed(
        spark, lambda: list_detail(hot(spark).withColumn("d0", F.lit(1)),
                                   details.repartition(3), ["job_id"]))
    assert n == 30_000
    assert "skew=true" in plan
    few = spark.createDataFrame([("k1", 1)], "job_id string, d int")
    assert list_detail(hot(spark), few, ["job_id"]).count() == 1


def test_outcomes(spark):
    classified = spark.createDataFrame(
        [("s", "accepted", 3, True), ("s", "accepted", 1, True), ("s", "rejected", 2, True), ("s", "rejected", 4, False),
         ("s", "skipped_seen", 5, True), ("s", "skipped_place", 7, False), ("s", "no_detail", 2, True),
         ("t", "accepted", 1, None)],
        "source string, outcome string, copies long, claimed boolean")
    want = {("s", "accepted"): 2, ("s", "rejected"): 5, ("s", "duplicate"): 4, ("s", "skipped_seen"): 5,
            ("s", "skipped_place"): 7, ("s", "no_detail"): 1, ("t", "accepted"): 1}
    assert {(r.source, r.outcome): r.n for r in outcomes(classified).collect()} == want


def test_two_crawls_in_any_order_of_rows(spark):
    """The earlier collected page wins whatever order rows come in, and bad records do not merge."""
    import datetime

    from payloads import AT, detail, landed, page

    from vacantia.plans import classify_dice

    def crawl(word, days):
        entries = [{"detailUrl": "http://h/result/a?src=1", "jobTitle": word}, {"detailUrl": "http://h/x", "jobTitle": word}]
        row = list(page("dice", {"resultItemList": entries}))
        row[8] = AT + datetime.timedelta(days)
        return tuple(row)

    early, late = crawl("early", 0), crawl("late", 1)
    for lists in ([early, late], [late, early], [late, early, early]):
        rows = classify_dice(landed(spark, [*lists, detail("dice", "a", "<div id=jobdescSec>d</div>")])).collect()
        tally = {r.outcome: r.n for r in outcomes(classify_dice(landed(spark, [*lists, detail("dice", "a", "d")]))).collect()}
        assert [r.title for r in rows if r.outcome == "accepted"] == ["early"]
        assert sum(r.outcome == "rejected" for r in rows) == 2
        assert tally == {"accepted": 1, "rejected": len(lists), "duplicate": len(lists) - 1}


def test_explode_listings(spark):
    listings = [{"type": "A", "elements": ["x", "y"]}, {"type": "B", "elements": []},
                {"type": "C", "elements": ["z"]}]
    df = spark.createDataFrame([("1", json.dumps(listings)), ("2", "[]"), ("3", None)],
                               "job_id string, j string")
    df = df.select("job_id", F.from_json("j", "array<struct<type string, elements array<string>>>")
                   .alias("listings"))
    assert [tuple(r) for r in explode_listings(df).collect()] == [
        ("1", 0, "A", 0, "x"), ("1", 0, "A", 1, "y"), ("1", 2, "C", 0, "z")]


def test_hot_id_in_a_plan(spark):
    """A third of the list records and of the pages share one id: one posting, all copies counted."""
    from payloads import detail, landed, page

    from vacantia.plans import classify_dice

    keys = ["hot" if i % 3 == 0 else f"k{i}" for i in range(300)]
    entries = [{"detailUrl": f"http://h/result/{k}?src=1", "jobTitle": f"T{i}"}
               for i, k in enumerate(keys)]
    rows = [page("dice", {"resultItemList": entries[i:i + 50]}, page=i // 50)
            for i in range(0, 300, 50)]
    rows += [detail("dice", k, f'<div id="jobdescSec">{i}</div>', url=f"http://h/{i:03}")
             for i, k in enumerate(keys)]
    got = {r.job_id: r for r in classify_dice(landed(spark, rows)).collect()}
    assert len(got) == 201 and all(r.outcome == "accepted" for r in got.values())
    assert (got["hot"].title, got["hot"].copies, got["hot"].role_description) == ("T0", 100, "0")
    assert (got["k299"].title, got["k299"].copies) == ("T299", 1)
