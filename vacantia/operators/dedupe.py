"""First row per key, and rows whose key is not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(
    df: DataFrame, key: Sequence[str], order: Sequence[str], copies: str | None = None
) -> DataFrame:
    """The first row of every key in the given order; ``copies`` names a count of all its rows.

    An aggregate rather than a window: every map task reduces its rows to one per key before the
    shuffle, so a key that holds a third of all rows costs one row per map task.
    """
    carried = [c for c in df.columns if c not in key]
    aggregates = [F.min_by(F.struct(*carried), F.struct(*order)).alias("_first")]
    if copies:
        aggregates.append(F.count("*").alias(copies))
    # The key comes from the grouping, so a later join on it finds the rows in place.
    return (
        df.groupBy(*key)
        .agg(*aggregates)
        .select(
            *(F.col(c) if c in key else F.col("_first")[c].alias(c) for c in df.columns),
            *([copies] if copies else []),
        )
    )


def only_new(
    df: DataFrame,
    seen: DataFrame,
    key: Sequence[str] = ("source", "job_id"),
    one_per_key: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``seen``; a NULL key is never in it.

    Stored ids are made distinct map-side first, so repeated ids do not travel; with ``distinct`` they already
    are, and stay in their buckets if they lie in any by these keys. Rows that are known
    to hold every key once, as :func:`first_seen` leaves them, stay where they are. Others may have
    a hot key: joining on a second hash of the key gives both sides an exchange of their own, right
    below the join, which is where AQE can split a partition that one key blows up.
    """
    ids = seen.select(*key) if distinct else seen.select(*key).distinct()
    if one_per_key:
        return df.join(ids, list(key), "left_anti")
    spread = F.xxhash64(*key)
    return (
        df.withColumn("_spread", spread)
        .join(ids.withColumn("_spread", spread), [*key, "_spread"], "left_anti")
        .drop("_spread")
    )
