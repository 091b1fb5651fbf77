"""The node table of landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.functions import html as H


def html_nodes(raw: DataFrame, body: str = "body", keep: tuple[str, ...] = ("list_id",)) -> DataFrame:
    """One row per element or text node, numbered in document order within its page."""
    parsed = raw.select(*keep, H.nodes(F.col(body)).alias("nodes"))
    rows = parsed.select(*keep, F.explode("nodes").alias("n"))
    return rows.select(
        *keep,
        F.col("n.no").alias("node_no"),
        F.col("n.parent").alias("parent_no"),
        F.col("n.last").alias("last_no"),
        F.col("n.nth").alias("nth"),
        F.col("n.tag").alias("tag"),
        F.col("n.id").alias("id"),
        F.col("n.class").alias("class"),
        F.col("n.href").alias("href"),
        F.col("n.text").alias("text"),
    )
