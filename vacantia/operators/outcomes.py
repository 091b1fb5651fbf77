"""Tally of what became of the collected records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Outcomes of a claimed id, which all but its first copy are duplicates of.
CLAIMED = ("accepted", "rejected", "no_detail")
SKIPPED = ("skipped_seen", "skipped_place")


def tally(df: DataFrame) -> DataFrame:
    """Rows per source and outcome; ``df`` has one row per record and outcome."""
    return df.groupBy("source", "outcome").agg(F.count("*").alias("n"))


def outcomes(classified: DataFrame) -> DataFrame:
    """Records per source and outcome, from rows that carry their outcome and the number of their copies.

    The copies of a claimed id beyond its first are its duplicates, so nothing but the first rows has
    to be kept to count them. A rejected record that claimed no id has none: copies of it are rejected
    too. Every copy of a skipped record is skipped.
    """
    n, outcome = F.col("copies"), F.col("outcome")
    once = F.coalesce(F.col("claimed"), F.lit(True)) & outcome.isin(*CLAIMED)
    counts = [
        F.sum(F.when(outcome == name, F.when(once, 1).otherwise(n))).alias(name)
        for name in (*CLAIMED, *SKIPPED)
    ]
    totals = classified.groupBy("source").agg(*counts, F.sum(F.when(once, n - 1)).alias("duplicate"))
    names = [c for c in totals.columns if c != "source"]
    return totals.unpivot("source", names, "outcome", "n").filter(F.col("n") > 0)
