"""Steps that every posting plan shares: claim an id, attach the detail, classify the outcome.

A plan is three functions: ``listed`` reads list records, ``details`` reads detail pages, ``finish``
classifies a claimed record with its detail. An id is claimed by its first record that gets as far as
having one, even if the rest of that record turns out bad. Classified rows are accepted or rejected,
or tell what was skipped: ``skipped_seen`` and ``skipped_place`` records, and claimed records
with ``no_detail`` yet.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia import schemas
from vacantia.operators.dedupe import first_seen
from vacantia.sources.landed import pages_of

PAGE_ORDER = ["term_no", "page", "pos"]
#: What comes first: the earlier collected page, then its place, then the entry.
ARRIVAL = ["fetched_at", *PAGE_ORDER, "item_no", "url"]
CLAIM = ["source", "claim"]

CLASSIFIED = T.StructType(
    [
        *schemas.STORED_POSTING.fields,
        T.StructField("outcome", T.StringType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("claimed", T.BooleanType()),
    ]
)


class Plan(NamedTuple):
    """What a source's plan is made of; ``details`` is None where the list has all there is."""

    listed: Callable[[DataFrame], DataFrame]
    details: Callable[[DataFrame], DataFrame] | None
    finish: Callable[..., DataFrame]

    def classify(self, raw: DataFrame, seen: DataFrame | None = None, **options) -> DataFrame:
        claimed = claim(self.listed(raw), seen)
        if self.details is not None:
            claimed = attach_details(claimed, self.details(raw))
        return self.finish(claimed, **options)


def claim(records: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """First row per source and ``list_id``, with ``copies`` and, where it is no more than counted, ``skip``.

    A row with a ``problem`` claims nothing: it gets a key made of where it came from and of the record
    itself, goes through the same shuffle and stays, so that the list is read and parsed once for good
    and bad records, and the records of two crawls stay apart. Rows that arrive with a ``skip`` are
    counted under one key, map-side. Ids that earlier runs stored are marked as skipped. A
    ``claim_problem`` stops a record after it has claimed its id.
    """
    for name in ("skip", "claim_problem"):
        if name not in records.columns:
            records = records.withColumn(name, F.lit(None).cast("string"))
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ARRIVAL)
    content = F.xxhash64(F.to_json("item"), "page_body")
    own = F.concat_ws("\u0000", F.lit(""), *texts, content.cast("string"))
    keyed = records.drop("query_term").withColumn(
        "claim",
        F.when(F.col("skip").isNotNull(), F.concat(F.lit("\u0000"), "skip"))
        .when(F.col("problem").isNull(), F.coalesce(F.col("list_id"), F.lit("\u0000")))
        .otherwise(own),
    )
    first = first_seen(keyed, CLAIM, ARRIVAL, copies="copies")
    counted = F.col("skip").isNotNull()
    first = first.withColumn("problem", F.when(~counted, F.col("problem")))
    first = first.withColumn("list_id", F.when(~counted, F.col("list_id")))
    first = first.withColumn("claimed", F.col("problem").isNull() & ~counted)
    return first if seen is None else mark_known(first, seen.select("source", "job_id").distinct())


def mark_known(claimed: DataFrame, *seen: DataFrame) -> DataFrame:
    """Claims with those skipped whose id earlier runs stored; ``seen`` has ``source`` and ``job_id``, once each.

    The claims hold every id once and the stored ids may be many, so each part is joined by itself: one that lies in
    buckets by source and id stays where it is.
    """
    for ids in seen:
        known = ids.select("source", F.col("job_id").alias("claim"), F.lit(True).alias("known"))
        met = claimed.join(known, CLAIM, "left")
        skip = F.when(F.col("known") & F.col("claimed") & F.col("skip").isNull(), F.lit("skipped_seen"))
        claimed = met.withColumn("skip", F.coalesce(skip, "skip")).drop("known")
    return claimed


def merged_claims(claimed: DataFrame, waiting: DataFrame) -> DataFrame:
    """Claims together with those that wait for their detail from earlier batches; the earlier one stays.

    Of its ``copies``, ``waited`` came with the earlier batches.
    """
    sums = ("copies", "waited")
    claimed, waiting = claimed.withColumn("waited", F.lit(0).cast("bigint")), waiting.withColumn("waited", F.col("copies"))
    both = claimed.unionByName(waiting, allowMissingColumns=True)
    carried = [c for c in both.columns if c not in (*CLAIM, *sums)]
    first = both.groupBy(*CLAIM).agg(
        F.min_by(F.struct(*carried), F.struct(*ARRIVAL)).alias("_first"), *(F.sum(c).alias(c) for c in sums)
    )
    return first.select(
        *(F.col(c) if c in (*CLAIM, *sums) else F.col("_first")[c].alias(c) for c in both.columns)
    )


def detail_pages(raw: DataFrame, source: str) -> DataFrame:
    """Landed detail pages by the id they were fetched for."""
    pages = pages_of(raw, source, "detail").filter(
        F.col("list_id").isNotNull() & F.col("body").isNotNull()
    )
    return pages.select(
        "source",
        F.col("list_id").alias("claim"),
        F.col("url").alias("detail_url"),
        F.col("fetched_at").alias("detail_at"),
        F.lit(True).alias("arrived"),
        *PAGE_ORDER,
        "body",
    )


def attach_details(claimed: DataFrame, details: DataFrame) -> DataFrame:
    """Claimed records with what was read from their page; those whose page never arrived say so.

    ``details`` are :func:`detail_pages` with fields in place of the body: a page is read where it
    lies, and only its fields travel. Both sides come out of an aggregate by id and join in place.
    """
    joined = claimed.drop(*PAGE_ORDER).join(first_details(details), CLAIM, "left")
    missing = F.col("claimed") & F.col("arrived").isNull() & F.col("claim_problem").isNull()
    return joined.withColumn("skip", F.coalesce("skip", F.when(missing, F.lit("no_detail"))))


def first_details(details: DataFrame) -> DataFrame:
    return first_seen(details, CLAIM, ["detail_at", *PAGE_ORDER, "detail_url"]).drop(*PAGE_ORDER)


def first_problem(*problems: Column) -> Column:
    return F.coalesce(F.col("problem"), F.col("claim_problem"), *problems)


def classified(df: DataFrame, problem: Column, record: Column, **columns: Column) -> DataFrame:
    """Rows in the classified schema: posting columns of good rows, record and reason of bad ones."""
    checked = df.withColumn("error_reason", F.when(F.col("skip").isNull(), problem))
    good = F.col("error_reason").isNull() & F.col("skip").isNull()
    outcome = F.coalesce("skip", F.when(good, F.lit("accepted")).otherwise(F.lit("rejected")))
    bad = F.col("error_reason").isNotNull()
    out = []
    for field in CLASSIFIED.fields:
        if field.name == "outcome":
            value = outcome
        elif field.name == "record":
            value = F.when(bad, record)
        elif field.name in ("source", "list_id", "error_reason", "copies", "claimed"):
            value = F.col(field.name)
        elif field.name in columns:
            value = F.when(good, columns[field.name])
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return checked.select(*out)


def no_listings() -> Column:
    return F.array().cast(schemas.LISTINGS)


def split_outcomes(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` of classified rows."""
    accepted = df.filter(F.col("outcome") == "accepted").select(
        "source", "list_id", *columns, "date_posted_raw"
    )
    rejected = df.filter(F.col("outcome") == "rejected").select(
        "source", "list_id", "error_reason", "record"
    )
    return accepted, rejected
