"""Incremental ingest: landed files in, postings, rejected records and seen ids out.

One stream run with ``availableNow`` takes what has landed since the last one. Every micro-batch
writes folders of its own run (named after its checkpoint) and batch id and replaces them whole when
it is replayed, so losing the job between two writes repeats work but never rows, and runs never touch
each other's. Ids are taken from rows that were written, so a rejected record is tried again when it is
collected again. Stored ids are a ledger (:mod:`vacantia.streaming.ledger`), put together while streams go on.

List records whose detail page has not landed wait in the store, and so do detail pages whose list
record has not. Each batch writes all that still waits after it, and the next batch of the run reads no more
than that, joined with what it brings; so what a batch reads depends on what is open, not on how many
batches there were. Lists are read and claimed once a batch, then taken from the store. Each batch
also writes a tally of its outcomes, and tallies add up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia import schemas
from vacantia.operators.dedupe import only_new
from vacantia.operators.membership import key_bits, may_be_among
from vacantia.operators.outcomes import outcomes
from vacantia.plans import KEEPS_IDS, PLANS
from vacantia.plans import common
from vacantia.sources import files
from vacantia.sources.landed import pages_of
from vacantia.sources.stored import if_there, read_table
from vacantia.streaming import ledger
from vacantia.streaming.ledger import register, run_of

RUN = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
RECORDS = T.StructType([*common.CLASSIFIED.fields, *RUN])
SEEN = T.StructType([*schemas.SEEN.fields, *RUN])
PAGES = T.StructType([*schemas.RAW.fields, *RUN])
TALLY = schemas.plain("source string, outcome string, n long")
KEY = ["source", "job_id"]


def records_path(store: str) -> str:
    return f"{store}/records"


def seen_path(store: str) -> str:
    return f"{store}/seen"


def tally_path(store: str) -> str:
    return f"{store}/tally"


def waiting_path(store: str, kind: str) -> str:
    """Where list records (``list``) or detail pages (``detail``) wait for each other."""
    return f"{store}/waiting_{kind}"


def _folder(source: str, run: str, batch_id: int) -> str:
    return f"source={source}/run={run}/batch_id={batch_id}"


def read_records(
    spark: SparkSession, store: str, source: str | None = None, batch: str | None = None
) -> DataFrame:
    """Classified records, of one source or one of its batches (``run=.../batch_id=...``) if named."""
    return _read(spark, records_path(store), RECORDS, source, batch)


def _read(spark, path, schema, source=None, batch=None) -> DataFrame:
    """A table by its partition folders, so that no more of them are listed than are read."""
    part = "/".join(p for p in (path, source and f"source={source}", batch) if p)
    return read_table(spark, part, schema, base=path)


def read_stored_postings(
    spark: SparkSession, store: str, source: str | None = None, batch: str | None = None
) -> DataFrame:
    records = read_records(spark, store, source, batch)
    accepted = records.filter(F.col("outcome") == "accepted")
    return accepted.select(*schemas.STORED_POSTING.names, "run", "batch_id")


def read_rejected(spark: SparkSession, store: str) -> DataFrame:
    rejected = read_records(spark, store).filter(F.col("outcome") == "rejected")
    return rejected.select("source", "list_id", "error_reason", "record", "run", "batch_id")


def read_stored_seen(spark: SparkSession, store: str, source: str | None = None) -> DataFrame:
    """Stored ids; those that were put together have run ``compacted`` and batch -1."""
    path = seen_path(store)
    known = ledger.manifest(spark, path)
    rows = ledger.open_batches(spark, path, SEEN, known, source)
    old = ledger.generation(spark, path, schemas.SEEN, KEY, known)
    if old is None:
        return rows
    old = old if source is None else old.filter(F.col("source") == source)
    return rows.unionByName(old.withColumns({"run": F.lit("compacted"), "batch_id": F.lit(-1).cast("bigint")}))


def seen_parts(spark: SparkSession, store: str, source: str, but: str | None = None, batch_id: int = 0) -> list[DataFrame]:
    """Stored ids of a source, each once: those put together, as they lie in their buckets, and the batches since.

    ``but`` and ``batch_id`` name the batch whose own ids do not count.
    """
    path = seen_path(store)
    known = ledger.manifest(spark, path)
    fresh = ledger.open_batches(spark, path, SEEN, known, source)
    if but is not None:
        fresh = fresh.filter(~((F.col("run") == but) & (F.col("batch_id") == batch_id)))
    parts = [fresh.select(*KEY).distinct()]
    old = ledger.generation(spark, path, schemas.SEEN, KEY, known)
    return parts if old is None else [old.filter(F.col("source") == source), *parts]


def add_seen(ids: DataFrame, store: str) -> None:
    """Take over ids that are known from elsewhere, as a run of its own with batch -1."""
    known = ids.select("source", "job_id").distinct()
    known = known.withColumns({"run": F.lit(f"{ledger.IMPORT}{uuid.uuid4().hex}"), "batch_id": F.lit(-1)})
    known.write.mode("append").partitionBy("source", "run", "batch_id").parquet(ledger.batches_path(seen_path(store)))


def compact_seen(spark: SparkSession, store: str) -> bool:
    """Put the ids of all committed batches together, in buckets by source and id; streams may go on meanwhile."""
    return ledger.compact(spark, seen_path(store), schemas.SEEN, lambda ids: ids.select(*KEY).distinct(), KEY)


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace a folder whole, so that no partition of an earlier attempt stays behind."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def _batches(spark: SparkSession, path: str, source: str, run: str) -> list[int]:
    """Batches of a run that have a folder, a few at most."""
    names = files.folders(spark, f"{path}/source={source}/run={run}")
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def _last(spark: SparkSession, path: str, source: str, run: str, before: int) -> str | None:
    """The folder that holds what waited after the last batch before one."""
    earlier = [b for b in _batches(spark, path, source, run) if b < before]
    return f"{path}/{_folder(source, run, earlier[-1])}" if earlier else None


def waiting_claims(spark: SparkSession, store: str, source: str, run: str, before: int) -> DataFrame | None:
    """List records of a run that wait for their detail page when a batch begins; None if none ever did."""
    folder = _last(spark, waiting_path(store, "list"), source, run, before)
    rows = folder and if_there(lambda: spark.read.parquet(folder), lambda: None)
    return rows and rows.withColumn("source", F.lit(source))


def waiting_pages(spark: SparkSession, store: str, source: str, run: str, before: int) -> DataFrame:
    """Detail pages of a run that wait for their list record when a batch begins."""
    folder = _last(spark, waiting_path(store, "detail"), source, run, before)
    if folder is None:
        return spark.createDataFrame([], schemas.RAW)
    kept = T.StructType([f for f in schemas.RAW if f.name != "source"])
    return read_table(spark, folder, kept).withColumn("source", F.lit(source)).select(*schemas.RAW.names)


def ingest_batch(
    landed: DataFrame,
    batch_id: int,
    store: str,
    source: str,
    incremental: bool | None = None,
    run: str = "direct",
) -> None:
    """Classify one batch of landed payloads and store what came of it; other sources are left alone.

    ``incremental`` keeps stored ids from being taken again; by default it is on for the sources
    that keep ids. A source without is collected afresh: what its older batches stored is replaced.
    """
    spark, plan = landed.sparkSession, PLANS[source]
    incremental = source in KEEPS_IDS if incremental is None else incremental
    landed = landed.filter(F.col("source") == source)
    if landed.isEmpty():
        return
    folder = _folder(source, run, batch_id)
    claimed = common.claim(plan.listed(landed))
    if not incremental:
        if plan.details is not None:
            claimed = common.attach_details(claimed, plan.details(landed))
        rows = plan.finish(claimed).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        whole = f"{records_path(store)}/source={source}"
        _replace(rows.drop("source"), whole, "run", "batch_id", "outcome")
        tally = outcomes(read_records(spark, store, source)).drop("source")
        _replace(tally.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)}), f"{tally_path(store)}/source={source}", "run", "batch_id")
        return
    if plan.details is not None:
        waiting = waiting_claims(spark, store, source, run, batch_id)
        claimed = claimed if waiting is None else common.merged_claims(claimed, waiting)
    claimed = common.mark_known(claimed, *seen_parts(spark, store, source, run, batch_id))
    if "waited" in claimed.columns:  # what waited for an id that another run has stored is not counted again
        known = F.col("skip") == "skipped_seen"
        copies = F.when(known, F.col("copies") - F.col("waited")).otherwise(F.col("copies"))
        claimed = claimed.withColumn("copies", copies).filter(F.col("copies") > 0).drop("waited")
    joined, staged = claimed, f"{store}/claims/{folder}"
    if plan.details is not None:
        _replace(claimed, staged)  # lists are read, parsed and claimed here and never again
        claimed = spark.read.schema(claimed.schema).parquet(staged)
        pages = pages_of(landed, source, "detail").filter(F.col("list_id").isNotNull())
        pages = pages.unionByName(waiting_pages(spark, store, source, run, batch_id))
        joined = common.attach_details(claimed, plan.details(pages_in_question(pages, claimed)))
    rows = plan.finish(joined).filter(F.col("outcome") != "no_detail").drop("source")
    _replace(rows, f"{records_path(store)}/{folder}", "outcome")
    records = read_records(spark, store, source, folder.split("/", 1)[1])
    # Both the id a posting was listed under and its own: either one marks it as stored.
    taken = records.filter(F.col("outcome") == "accepted")
    ids = taken.select(F.explode(F.array_distinct(F.array("list_id", "job_id"))).alias("job_id"))
    _replace(ids.filter(F.col("job_id").isNotNull()), f"{ledger.batches_path(seen_path(store))}/{folder}")
    _replace(outcomes(records).drop("source").coalesce(1), f"{tally_path(store)}/{folder}")
    if plan.details is not None:
        _keep_waiting(claimed, pages, records, store, source, run, batch_id)
        files.remove(spark, staged)


def pages_in_question(pages: DataFrame, claimed: DataFrame) -> DataFrame:
    """Pages without nearly all of those whose ids are stored, foreign or not listed: parsing is what costs.

    The open ids are a bit map of fixed size, so the pages stay where they lie, whatever the number of ids.
    """
    wanted = claimed.filter(F.col("claimed") & F.col("skip").isNull()).select(F.col("claim").alias("list_id"))
    return may_be_among(pages, "list_id", key_bits(wanted, "list_id"))


def _keep_waiting(
    claimed: DataFrame, pages: DataFrame, records: DataFrame, store: str, source: str, run: str, batch_id: int
) -> None:
    """Store all that waits after this batch: claims without a page, and pages of ids that nothing has listed.

    What waited before the last committed batch is deleted: no replay asks for it.
    """
    spark, folder = claimed.sparkSession, _folder(source, run, batch_id)
    settled = records.filter(F.col("outcome").isin("accepted", "rejected") & F.col("list_id").isNotNull())
    settled = settled.select(F.lit(source).alias("source"), F.col("list_id").alias("job_id")).distinct()
    of_claim = settled.select(F.col("job_id").alias("claim"))
    still = claimed.filter(F.col("claimed") & F.col("skip").isNull() & F.col("claim_problem").isNull())
    _replace(still.join(of_claim, "claim", "left_anti").drop("source"), f"{waiting_path(store, 'list')}/{folder}")
    ids = pages.select("source", F.col("list_id").alias("job_id")).distinct()
    for known in (settled, *seen_parts(spark, store, source)):
        ids = only_new(ids, known, one_per_key=True, distinct=True)
    # Ids first, as they are small; then only the pages that are kept move.
    unlisted = ids.select(F.col("job_id").alias("list_id"))
    _replace(pages.join(unlisted, "list_id", "left_semi").drop("source"), f"{waiting_path(store, 'detail')}/{folder}")
    done = ledger.committed(spark, seen_path(store)).get(run, -1)
    for kind in ("list", "detail"):
        settled_by = [b for b in _batches(spark, waiting_path(store, kind), source, run) if b <= done]
        for old in settled_by[:-1]:
            files.remove(spark, f"{waiting_path(store, kind)}/{_folder(source, run, old)}")


def ingest(
    spark: SparkSession,
    landed: str,
    store: str,
    checkpoint: str,
    source: str,
    incremental: bool | None = None,
):
    """Start the stream for one source; it ends when everything landed has been taken.

    Only the folder of the source is listed, so it must have landed something.
    """
    run = register(spark, seen_path(store), checkpoint)
    stream = (
        spark.readStream.schema(schemas.RAW)
        .parquet(f"{landed}/source={source}")
        .withColumn("source", F.lit(source))
    )
    return (
        stream.writeStream.foreachBatch(
            lambda df, batch_id: ingest_batch(df, batch_id, store, source, incremental, run)
        )
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest-{source}")
        .trigger(availableNow=True)
        .start()
    )


def stored_outcomes(spark: SparkSession, store: str) -> DataFrame:
    """Records per source and outcome over all batches, with those that still wait for their page.

    Tallies of the batches are added up; only what waits is counted here, from the last batch of each run.
    """
    told = read_table(spark, tally_path(store), TALLY).select(*TALLY.names)
    path = waiting_path(store, "list")
    keys = schemas.plain("source string, claim string, copies long, run string, batch_id long")
    rows = read_table(spark, path, keys)
    newest = rows.sparkSession.createDataFrame(
        [
            (source.split("=")[1], run.split("=")[1], batches[-1])
            for source in files.folders(spark, path)
            for run in files.folders(spark, f"{path}/{source}")
            if (batches := _batches(spark, path, source.split("=")[1], run.split("=")[1]))
        ],
        "source string, run string, batch_id long",
    )  # one row a run
    open_claims = rows.join(F.broadcast(newest), ["source", "run", "batch_id"], "left_semi")
    stored = read_stored_seen(spark, store).select("source", F.col("job_id").alias("claim"))
    open_claims = open_claims.join(stored, ["source", "claim"], "left_anti")
    open_claims = open_claims.groupBy("source", "claim").agg(F.sum("copies").alias("copies"))
    waiting = outcomes(
        open_claims.select("source", F.lit("no_detail").alias("outcome"), "copies", F.lit(True).alias("claimed"))
    )
    both = told.unionByName(waiting).groupBy("source", "outcome").agg(F.sum("n").alias("n"))
    return both.filter(F.col("n") > 0)
