"""Landed payloads: the raw table, and the records inside JSON bodies and arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.functions import json as J

# Columns that say where a record came from and in which order it arrived.
ORIGIN = ["source", "query_term", "term_no", "page", "pos", "url", "fetched_at"]


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The landed table; keep it partitioned by source and kind so a plan reads its part only."""
    return spark.read.schema(schemas.RAW).parquet(path)


def pages_of(raw: DataFrame, source: str, kind: str = "list") -> DataFrame:
    return raw.filter((F.col("source") == source) & (F.col("kind") == kind))


def _items(pages: DataFrame) -> DataFrame:
    """One row per entry of ``entries``; a page with a problem is one row that keeps its body."""
    # The body is given up before the explode, or every entry would carry its whole page along.
    slim = pages.select(
        *ORIGIN,
        F.col("page_problem").alias("problem"),
        F.when(F.col("page_problem").isNotNull(), F.col("body")).alias("page_body"),
        F.when(F.col("page_problem").isNull(), F.col("entries")).alias("entries"),
    )
    exploded = slim.select(
        *ORIGIN, "problem", "page_body", F.posexplode_outer("entries").alias("item_no", "item")
    )
    return exploded.filter(F.col("item_no").isNotNull() | F.col("problem").isNotNull())


def json_items(pages: DataFrame, key: str, page_check=None) -> DataFrame:
    """Entries of the list under ``key``, each a VARIANT ``item`` with its place ``item_no``.

    A missing key is an empty list. A body that is not JSON, or anything but a list under the key,
    makes the whole page a problem row. ``page_check`` adds a problem from the parsed body.
    """
    parsed = pages.withColumn("doc", F.try_parse_json("body")).withColumn(
        "entries", F.try_variant_get("doc", J.path_of(key), "array<variant>")
    )
    doc, entries = F.col("doc"), F.col("entries")
    problem = (
        F.when(doc.isNull(), F.lit("body is not JSON"))
        .when(~J.is_object(doc), F.lit("body is not an object"))
        .when(entries.isNull() & J.member(doc, key).isNotNull(), F.lit(f"{key} is not a list"))
    )
    if page_check is not None:
        problem = F.coalesce(problem, page_check(doc))
    return _items(parsed.withColumn("page_problem", problem))


def array_items(pages: DataFrame, entries, problem=None) -> DataFrame:
    """Entries of an array computed from the page, for HTML and XML lists."""
    page_problem = J.no_problem() if problem is None else problem
    return _items(pages.withColumn("page_problem", page_problem).withColumn("entries", entries))
