"""Long form of the section lists of postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_listings(postings: DataFrame, keep: tuple[str, ...] = ("source", "job_id")) -> DataFrame:
    """One row per section element: section number and type, element number and element."""
    kept = [c for c in keep if c in postings.columns]
    sections = postings.select(*kept, F.posexplode("listings").alias("section_no", "section"))
    return sections.select(
        *kept,
        "section_no",
        F.col("section.type").alias("type"),
        F.posexplode("section.elements").alias("element_no", "element"),
    )
