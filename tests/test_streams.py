import datetime

import pytest
from payloads import detail, page
from test_heat import SITES

from vacantia import schemas
from vacantia.operators import heat
from pyspark.sql import functions as F

from vacantia.operators.dedupe import only_new
from vacantia.streaming import ingest as I
from vacantia.streaming import ledger, weekly


def items(*keys, bad=()):
    return page("dice", {"resultItemList": [
        {"detailUrl": f"http://h/result/{k}?src=1", "jobTitle": None if k in bad else f"T {k}"}
        for k in keys]})


def details(*keys):
    return [detail("dice", k, f'<div id="jobdescSec">{k}</div>') for k in keys]


FACEBOOK = (
    '<div class="_3k6i"><a class="_5144" href="/careers/jobs/{0}/">J</a><div class="_3k6n">A, CA</div></div>',
    '<div class="_4ycv"><div><h1 class="_4ycw">T</h1><div class="_4ycx">(A, CA)</div>'
    '<a id="u_0_d" href="/careers/resume?req={0}">Apply</a></div></div>',
)
REQUISITION = "<requisition><jobId>{0}</jobId><jobFunction>E</jobFunction></requisition>"
TWO = ("j1", "j2")
# One list page with two records, and their detail pages, of every source that has any.
PARTS = {
    "dice": ([items(*TWO)], details(*TWO)),
    "apple": (
        [page("apple", f"<result><count>2</count>{''.join(map(REQUISITION.format, TWO))}</result>")],
        [detail("apple", k, {"requisitionInfo": {"formId": k, "postingTitle": "T"}}) for k in TWO],
    ),
    "facebook": (
        [page("facebook", "".join(map(FACEBOOK[0].format, TWO)))],
        [detail("facebook", k, FACEBOOK[1].format(k)) for k in TWO],
    ),
    "indeed": (
        [page("indeed", {"results": [{"jobkey": k, "url": f"http://h/{k}", "jobtitle": "T"} for k in TWO]})],
        [detail("indeed", k, "<table id='job-content'></table>") for k in TWO],
    ),
}


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        landed, store, checkpoint = (str(tmp_path / d) for d in ("landed", "store", "checkpoint"))

        def land(self, *rows):
            df = spark.createDataFrame(list(rows), schemas.RAW)
            df.write.mode("append").partitionBy("source", "kind").parquet(self.landed)

        def run(self, source="dice", incremental=None, checkpoint=None):
            where = checkpoint or self.checkpoint
            I.ingest(spark, self.landed, self.store, where, source, incremental).awaitTermination()

        def tally(self):
            return {r.outcome: r.n for r in I.stored_outcomes(spark, self.store).collect()}

        def stored(self):
            rows = I.read_stored_postings(spark, self.store).collect()
            return sorted((r.job_id, r.batch_id) for r in rows)

        def seen(self):
            return sorted((r.job_id, r.batch_id) for r in I.read_stored_seen(spark, self.store).collect())

        def rejected(self):
            return sorted((r.list_id, r.batch_id) for r in I.read_rejected(spark, self.store).collect())

    return Place()


def test_runs_take_only_new_postings(spark, place):
    place.land(items("a", "b", "a"), *details("a", "b"))
    place.run()
    assert place.stored() == place.seen() == [("a", 0), ("b", 0)]
    place.run()
    place.land(items("b", "c"), *details("b", "c"))
    place.run()
    place.run()
    assert place.stored() == place.seen() == [("a", 0), ("b", 0), ("c", 1)]
    assert place.tally() == {"accepted": 3, "duplicate": 1, "skipped_seen": 1}


def test_rejected_rows_are_tried_again(spark, place):
    place.land(items("a", "b", bad=["b"]), *details("a", "b"))
    place.run()
    assert (place.stored(), place.rejected()) == ([("a", 0)], [("b", 0)])
    assert place.seen() == [("a", 0)]
    place.land(items("b"), *details("b"))
    place.run()
    assert place.stored() == [("a", 0), ("b", 1)]
    reason = I.read_rejected(spark, place.store).first()
    assert reason.error_reason == "jobTitle is not text" and '"jobTitle":null' in reason.record


def test_details_that_did_not_arrive_leave_the_id_open(spark, place):
    place.land(items("a", "b"), *details("a"))
    place.run()
    assert place.tally() == {"accepted": 1, "no_detail": 1}
    place.land(items("b"), *details("b"))
    place.run()
    assert place.stored() == [("a", 0), ("b", 1)]
    assert place.tally() == {"accepted": 2, "duplicate": 1}


@pytest.mark.parametrize(
    "source, lists_first",
    [("dice", True), ("apple", False), ("facebook", True), ("facebook", False), ("indeed", True)],
)
def test_lists_and_details_of_different_runs_meet(spark, place, source, lists_first):
    lists, pages = PARTS[source]
    first, second = (lists, pages) if lists_first else (pages, lists)
    place.land(*first)
    place.run(source)
    assert (place.stored(), place.seen()) == ([], [])
    place.land(*second[:1])
    place.run(source)
    place.land(*second[1:])
    place.run(source)
    # A list page brings both records at once, detail pages come one by one.
    want = [("j1", 1), ("j2", 2)] if lists_first else [("j1", 1), ("j2", 1)]
    assert [(k, b) for k, b in place.stored() if k in ("j1", "j2")] == want
    assert place.rejected() == []
    assert place.tally() == {"accepted": 2}


def test_a_replayed_batch_finds_what_waits_again(spark, place):
    frame = lambda *rows: spark.createDataFrame(list(rows), schemas.RAW)
    for batch, rows in ((0, [items("a", "b")]), (1, details("a")), (1, details("a")), (2, details("b")), (1, details("a"))):
        I.ingest_batch(frame(*rows), batch, place.store, "dice")
    assert place.stored() == [("a", 1), ("b", 2)]
    assert place.tally() == {"accepted": 2}


def test_a_record_that_waits_after_a_rejected_copy(spark, place):
    place.land(items("a", bad=["a"]), *details("a"))
    place.run()
    place.land(items("a"))
    place.run()
    assert place.tally() == {"rejected": 1, "no_detail": 1}
    place.land(*details("a"))
    place.run()
    assert (place.stored(), place.rejected()) == ([("a", 2)], [("a", 0)])
    assert place.tally() == {"accepted": 1, "rejected": 1}


def test_runs_of_two_checkpoints_do_not_touch_each_other(spark, place, tmp_path):
    place.land(items("a"), *details("a"))
    place.run()
    place.landed = str(tmp_path / "landed2")
    place.land(items("b"), *details("b"))
    place.run(checkpoint=str(tmp_path / "checkpoint2"))
    assert place.stored() == place.seen() == [("a", 0), ("b", 0)]


def test_a_run_that_finds_nothing_leaves_the_store_alone(spark, place):
    job = {"id": "a", "title": "T", "location": "US", "id_icims": "1"}
    place.land(page("amazon", {"jobs": [job, {**job, "id": "x", "location": "CA"}]}))
    place.run("amazon")
    place.land(items("d"), *details("d"))
    place.run("amazon")
    rows = spark.createDataFrame([items("d")], schemas.RAW)
    I.ingest_batch(rows, 7, place.store, "amazon")
    assert place.stored() == [("a", 0)]
    assert place.tally() == {"accepted": 1, "skipped_place": 1}


def test_replay_leaves_no_stale_outcome(spark, place):
    frame = lambda *rows: spark.createDataFrame(list(rows), schemas.RAW)
    I.ingest_batch(frame(items("a", bad=["a"]), *details("a")), 0, place.store, "dice")
    I.ingest_batch(frame(items("a"), *details("a")), 0, place.store, "dice")
    assert (place.stored(), place.rejected()) == ([("a", 0)], [])


def test_only_pages_of_open_ids_are_parsed(spark):
    landed = spark.createDataFrame([items("a", "b"), *details("a", "b", "c")], schemas.RAW)
    seen = spark.createDataFrame([("dice", "a")], schemas.SEEN)
    plan = I.PLANS["dice"]
    claimed = I.common.claim(plan.listed(landed), seen)
    pages = I.pages_in_question(landed, claimed)
    assert sorted(r.claim for r in plan.details(pages).collect()) == ["b"]


def test_compacted_ids_are_the_same_set(spark, place):
    for name in ("a", "b"):
        ids = spark.createDataFrame([("dice", name), ("apple", "z")], schemas.SEEN)
        I.add_seen(ids, place.store)
    place.land(items("c"), *details("c"))
    place.run()
    pairs = lambda: sorted((r.source, r.job_id) for r in I.read_stored_seen(spark, place.store).collect())
    before = pairs()
    I.compact_seen(spark, place.store)
    assert pairs() == sorted(set(before))
    place.land(items("a", "b", "c", "d"), *details("a", "b", "c", "d"))
    place.run()
    assert place.stored() == [("c", 0), ("d", 1)]


def test_replayed_batch_adds_nothing(spark, place):
    rows = spark.createDataFrame([items("a", "b"), *details("a", "b")], schemas.RAW)
    for _ in range(2):
        I.ingest_batch(rows, 0, place.store, "dice")
        assert place.stored() == place.seen() == [("a", 0), ("b", 0)]


def test_stop_between_postings_and_ids(spark, place, monkeypatch):
    place.land(items("a", "b"), *details("a", "b"))
    write = I._replace

    def fail(df, path, *partitions):
        if path.startswith(I.seen_path(place.store)):
            raise RuntimeError("lost")
        write(df, path, *partitions)

    monkeypatch.setattr(I, "_replace", fail)
    with pytest.raises(Exception, match="lost"):
        place.run()
    assert (place.stored(), place.seen()) == ([("a", 0), ("b", 0)], [])
    monkeypatch.setattr(I, "_replace", write)
    place.land(items("b", "c"), *details("c"))
    place.run()
    assert sorted(k for k, _ in place.stored()) == sorted(k for k, _ in place.seen()) == ["a", "b", "c"]


def test_known_ids_from_elsewhere(spark, place):
    I.add_seen(spark.createDataFrame([("dice", "a"), ("dice", "a")], schemas.SEEN), place.store)
    place.land(items("a", "b"), *details("a", "b"))
    place.run()
    assert place.stored() == [("b", 0)]
    assert place.seen() == [("a", -1), ("b", 0)]
    I.add_seen(spark.createDataFrame([("dice", "z")], schemas.SEEN), place.store)
    assert place.seen() == [("a", -1), ("b", 0), ("z", -1)]


def test_sources_share_a_store(spark, place, tmp_path):
    job = {"id": "a", "title": "T", "location": "US", "id_icims": "1"}
    place.land(items("a"), *details("a"), page("amazon", {"jobs": [job]}))
    place.run()
    I.ingest(spark, place.landed, place.store, str(tmp_path / "c2"), "amazon", False).awaitTermination()
    assert place.stored() == [("a", 0), ("a", 0)]
    place.land(page("amazon", {"jobs": [job | {"id": "b"}]}))
    I.ingest(spark, place.landed, place.store, str(tmp_path / "c2"), "amazon", False).awaitTermination()
    amazon = I.read_stored_postings(spark, place.store, "amazon").collect()
    # Collected afresh: the newer run replaces the older, and no id is remembered.
    assert [(r.job_id, r.batch_id) for r in amazon] == [("b", 1)]
    assert ("a", 0) in place.stored()
    assert place.seen() == [("a", 0)]


def test_both_ids_are_remembered(spark, place):
    place.land(
        page("apple", "<result><count>1</count><requisition><jobId>l1</jobId><jobFunction>E"
             "</jobFunction></requisition></result>"),
        detail("apple", "l1", {"requisitionInfo": {"formId": "f1", "postingTitle": "T"}}))
    place.run("apple")
    assert place.seen() == [("f1", 0), ("l1", 0)]


def test_weekly_stream_agrees_with_batch(spark, tmp_path):
    landed, store, checkpoint = (str(tmp_path / d) for d in ("landed", "store", "checkpoint"))
    for part in (SITES[:4], SITES[4:], [(datetime.date(2017, 3, 9), 1.0, 2.0)] * 2):
        spark.createDataFrame(part, schemas.AGGREGATOR_SITE).write.mode("append").parquet(landed)
        weekly.count_days(spark, landed, store, checkpoint).awaitTermination()
        got = {tuple(r) for r in weekly.read_week_counts(spark, store).collect()}
        batch = heat.week_counts(spark.read.schema(schemas.AGGREGATOR_SITE).parquet(landed))
        assert got == {tuple(r) for r in batch.collect()}


def test_weekly_stream_keeps_no_state_and_compacts(spark, tmp_path):
    landed, store, checkpoint = (str(tmp_path / d) for d in ("landed", "store", "checkpoint"))
    for part in (SITES[:4], SITES[4:]):
        spark.createDataFrame(part, schemas.AGGREGATOR_SITE).write.mode("append").parquet(landed)
        weekly.count_days(spark, landed, store, checkpoint).awaitTermination()
    assert not (tmp_path / "checkpoint" / "state").exists()
    days = lambda: sorted(map(repr, weekly.read_day_counts(spark, store).collect()))
    before = days()
    weekly.compact_days(spark, store)
    assert days() == before
    spark.createDataFrame(SITES[:1], schemas.AGGREGATOR_SITE).write.mode("append").parquet(landed)
    weekly.count_days(spark, landed, store, checkpoint).awaitTermination()
    total = weekly.read_day_counts(spark, store).agg({"quantity": "sum"}).first()[0]
    assert total == len(SITES) + 1


def test_a_batch_replayed_after_compaction_gives_the_same_rows(spark, place, monkeypatch):
    place.land(items("a", "b"), *details("a", "b"))
    place.run()
    place.land(items("b", "c", "d"), *details("c", "d"))
    write = I._replace

    def fail(df, path, *partitions):
        write(df, path, *partitions)
        if path.startswith(I.seen_path(place.store)):
            raise RuntimeError("lost")  # ids are written, the batch is not committed

    monkeypatch.setattr(I, "_replace", fail)
    with pytest.raises(Exception, match="lost"):
        place.run()
    monkeypatch.setattr(I, "_replace", write)
    assert I.compact_seen(spark, place.store)
    assert place.seen() == [("a", -1), ("b", -1), ("c", 1), ("d", 1)]
    place.run()
    assert place.stored() == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    assert place.tally() == {"accepted": 4, "skipped_seen": 1}
    assert I.compact_seen(spark, place.store) and not I.compact_seen(spark, place.store)
    place.land(items("a", "d", "e"), *details("e"))
    place.run()
    assert place.stored() == [("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", 2)]


def test_a_batch_without_a_checkpoint_is_never_put_together(spark, place):
    rows = spark.createDataFrame([items("a", "b"), *details("a", "b")], schemas.RAW)
    I.ingest_batch(rows, 0, place.store, "dice")
    assert not I.compact_seen(spark, place.store)
    I.ingest_batch(rows, 0, place.store, "dice")
    assert place.stored() == place.seen() == [("a", 0), ("b", 0)]


def test_readers_during_a_compaction_see_the_generation_before(spark, place, monkeypatch):
    for name in ("a", "b"):
        I.add_seen(spark.createDataFrame([("dice", name)], schemas.SEEN), place.store)
    I.compact_seen(spark, place.store)
    I.add_seen(spark.createDataFrame([("dice", "c")], schemas.SEEN), place.store)
    reader, publish, found = I.read_stored_seen(spark, place.store), ledger._publish, []

    def look(*given):
        found.append(sorted(r.job_id for r in I.read_stored_seen(spark, place.store).collect()))
        publish(*given)

    monkeypatch.setattr(ledger, "_publish", look)
    I.compact_seen(spark, place.store)
    assert found == [["a", "b", "c"]]
    assert sorted(r.job_id for r in reader.collect()) == ["a", "b", "c"]
    monkeypatch.setattr(ledger, "_publish", lambda *given: (_ for _ in ()).throw(RuntimeError("lost")))
    I.add_seen(spark.createDataFrame([("dice", "d")], schemas.SEEN), place.store)
    with pytest.raises(RuntimeError):
        I.compact_seen(spark, place.store)
    assert [k for k, _ in place.seen()] == ["a", "b", "c", "d"]
    monkeypatch.setattr(ledger, "_publish", publish)
    I.compact_seen(spark, place.store)
    assert place.seen() == [("a", -1), ("b", -1), ("c", -1), ("d", -1)]


def test_stored_ids_stay_in_their_buckets(spark, place):
    I.add_seen(spark.range(5_000).selectExpr("'dice' AS source", "string(id) AS job_id"), place.store)
    I.compact_seen(spark, place.store)
    landed = spark.createDataFrame([items("7", "x")], schemas.RAW)
    old, fresh = I.seen_parts(spark, place.store, "dice")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        known = I.common.mark_known(I.common.claim(I.PLANS["dice"].listed(landed)), old)
        plan = known._jdf.queryExecution().executedPlan().toString()
        ids = only_new(landed.select("source", F.col("url").alias("job_id")), old, one_per_key=True, distinct=True)
        plans = [plan, ids._jdf.queryExecution().executedPlan().toString()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        stored = plan[plan.index("Join") :].split("\n")
        at = next(i for i, line in enumerate(stored) if "vacantia_g" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        above, level = [], depth(stored[at])
        for line in reversed(stored[:at]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        assert any("Bucketed: true" in line for line in stored)
        assert not any("Exchange" in line for line in above[: next(i for i, line in enumerate(above) if "Join" in line) + 1])
    assert {r.claim: r.skip for r in known.collect()} == {"7": "skipped_seen", "x": None}


def test_a_batch_reads_what_is_open_however_many_there_were(spark, place):
    place.land(items("open"), *details("unlisted"))
    place.run()
    counts = []
    for n in range(6):
        place.land(items(f"k{n}", f"w{n}"), *details(f"k{n}", *([f"w{n - 1}"] if n else [])))
        place.run()
        run = I.run_of(place.checkpoint)
        claims = I.waiting_claims(spark, place.store, "dice", run, 100)
        pages = I.waiting_pages(spark, place.store, "dice", run, 100)
        counts.append((sorted(r.claim for r in claims.collect()), [r.list_id for r in pages.collect()]))
        assert len(I._batches(spark, I.waiting_path(place.store, "list"), "dice", run)) <= 3
    assert counts == [(["open", f"w{n}"], ["unlisted"]) for n in range(6)]
    assert place.tally() == {"accepted": 11, "no_detail": 2}
    place.land(items("unlisted"), *details("open"))
    place.run()
    assert ("open", 7) in place.stored() and ("unlisted", 7) in place.stored()


def test_lists_are_parsed_once_in_a_batch(spark, place, monkeypatch):
    plan, log = I.PLANS["dice"], f"{place.store}-parsed"

    def listed(raw):
        def count(batches):
            for batch in batches:
                with open(log, "a") as out:
                    out.write("x" * batch.num_rows)
                yield batch

        return plan.listed(raw.filter("kind = 'list'").mapInArrow(count, raw.schema))

    monkeypatch.setitem(I.PLANS, "dice", plan._replace(listed=listed))
    place.land(items("a", "b"), *details("a"))
    place.run()
    assert open(log).read() == "x" and place.tally() == {"accepted": 1, "no_detail": 1}


def test_tallies_of_many_runs_add_up_in_a_plan_of_one_size(spark, place, tmp_path):
    sizes = []
    for n in range(3):
        place.landed = str(tmp_path / f"landed{n}")
        place.land(items(f"a{n}", "shared", f"w{n}"), *details(f"a{n}", "shared"))
        place.run(checkpoint=str(tmp_path / f"checkpoint{n}"))
        plan = I.stored_outcomes(spark, place.store)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.split("\n")))
    assert place.tally() == {"accepted": 4, "skipped_seen": 2, "no_detail": 3}
    assert len(set(sizes)) == 1


def test_days_replayed_after_compaction_count_once(spark, tmp_path, monkeypatch):
    landed, store, checkpoint = (str(tmp_path / d) for d in ("landed", "store", "checkpoint"))
    for part in (SITES[:4], SITES[4:]):
        spark.createDataFrame(part, schemas.AGGREGATOR_SITE).write.mode("append").parquet(landed)
        weekly.count_days(spark, landed, store, checkpoint).awaitTermination()
    (tmp_path / "checkpoint" / "commits" / "1").unlink()  # as if lost after the write, before the commit
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    days = lambda: sorted(map(repr, weekly.read_day_counts(spark, store).collect()))
    before = days()
    assert weekly.compact_days(spark, store)
    assert days() == before
    weekly.count_days(spark, landed, store, checkpoint).awaitTermination()
    assert days() == before
    assert weekly.compact_days(spark, store)
    assert days() == before
