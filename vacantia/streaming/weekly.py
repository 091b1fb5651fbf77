"""Postings per day and place, kept up to date by a stream.

The week of a posting depends on the newest date, which moves, so the stream counts days and the
week is taken when the table is read. Each batch stores counts of its own rows, and reading adds them
up: the stream keeps no state, and a replayed batch replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia import schemas
from vacantia.functions.dates import week_age
from vacantia.streaming import ledger

DAY = ["date_posted", "latitude", "longitude"]
TOTALS = T.StructType([*schemas.AGGREGATOR_SITE.fields, T.StructField("quantity", T.LongType())])


def count_days(spark: SparkSession, landed: str, store: str, checkpoint: str):
    """Start the stream: each batch writes the counts of its rows by day and place."""
    run = ledger.register(spark, store, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*DAY).agg(F.count("*").alias("quantity"))
        writer = counts.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.parquet(f"{ledger.batches_path(store)}/run={run}/batch_id={batch_id}")

    return (
        spark.readStream.schema(schemas.AGGREGATOR_SITE)
        .parquet(landed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*DAY).agg(F.sum("quantity").alias("quantity"))


def _counts(spark: SparkSession, store: str) -> DataFrame:
    known = ledger.manifest(spark, store)
    there = T.StructType([*TOTALS.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    rows = ledger.open_batches(spark, store, there, known).select(*TOTALS.names)
    old = ledger.generation(spark, store, TOTALS, known=known)
    return rows if old is None else rows.unionByName(old)


def read_day_counts(spark: SparkSession, store: str) -> DataFrame:
    """The total of every day and place."""
    return _added(_counts(spark, store))


def compact_days(spark: SparkSession, store: str) -> bool:
    """Put the counts of all committed batches together; the stream may go on meanwhile."""
    return ledger.compact(spark, store, TOTALS, _added)


def read_week_counts(spark: SparkSession, store: str) -> DataFrame:
    """Postings per week and place, as :func:`vacantia.operators.heat.week_counts` gives them."""
    counts = _counts(spark, store)
    newest = counts.agg(F.max("date_posted")).scalar()
    return (
        _added(counts).withColumn("week", week_age(newest, F.col("date_posted")))
        .groupBy("week", "latitude", "longitude")
        .agg(F.sum("quantity").alias("quantity"))
    )
