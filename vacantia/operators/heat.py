"""Postings per place, per week, and the cumulative week table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions.dates import week_age

PLACE = ("latitude", "longitude")


def site_counts(sites: DataFrame) -> DataFrame:
    """Postings per company and place."""
    return sites.groupBy("company", *PLACE).agg(F.count("*").alias("quantity"))


def selected_heat(counts: DataFrame, companies: Sequence[str]) -> DataFrame:
    """Postings per place of the selected companies; no company selected gives no rows."""
    chosen = F.col("company").isin(list(companies)) if companies else F.lit(False)
    return counts.filter(chosen).groupBy(*PLACE).agg(F.sum("quantity").alias("quantity"))


def aged_sites(sites: DataFrame, max_date=None) -> DataFrame:
    """Sites with their age in weeks before the newest date, one posting each.

    The newest date is a scalar subquery over the date column alone. Rows without a date keep a
    NULL week.
    """
    if max_date is None:
        newest = sites.agg(F.max("date_posted")).scalar()
    else:
        newest = max_date if isinstance(max_date, Column) else F.lit(max_date).cast("date")
    return sites.select(
        week_age(newest, F.col("date_posted")).alias("week"),
        *PLACE,
        F.lit(1).cast("bigint").alias("quantity"),
    )


def week_counts(sites: DataFrame, max_date=None) -> DataFrame:
    """Postings per week and place."""
    return (
        aged_sites(sites, max_date)
        .groupBy("week", *PLACE)
        .agg(F.sum("quantity").alias("quantity"))
    )


def site_list(weeks: DataFrame) -> DataFrame:
    """Every place, also those with old postings only."""
    return weeks.select(*PLACE).distinct()


def site_index(weeks: DataFrame, n: int = 5, form: str = "wide") -> DataFrame:
    """Cumulative postings per place: column ``A`` is 0, the i-th after it covers weeks 0 to i-1.

    One conditional aggregate in place of a join per week. ``weeks`` may be counted already
    (:func:`week_counts`) or hold one row per posting (:func:`aged_sites`), which saves a shuffle.
    NULL coordinates form a place of their own.
    """
    columns = week_columns(n)
    sums = [
        F.coalesce(
            F.sum(F.when(F.col("week").between(0, i - 1), F.col("quantity"))), F.lit(0)
        ).cast("bigint").alias(columns[i])
        for i in range(1, n + 1)
    ]
    wide = weeks.groupBy(*PLACE).agg(*sums).select(
        *PLACE, F.lit(0).cast("bigint").alias(columns[0]), *columns[1:]
    )
    if form == "wide":
        return wide
    if form != "long":
        raise ValueError(f"form is 'wide' or 'long', not {form!r}")
    steps = F.array(
        *(
            F.struct(F.lit(i).alias("week"), F.col(columns[i + 1]).alias("total"))
            for i in range(n)
        )
    )
    return wide.select(*PLACE, F.inline(steps))


def week_columns(n: int = 5) -> list[str]:
    """``A`` to ``Z``, then ``AA``, ``AB`` and so on, as sheets name their columns."""
    first, names = ord(fixed.WEEK_COLUMNS[0]), []
    for i in range(n + 1):
        name, i = "", i + 1
        while i:
            i, digit = divmod(i - 1, 26)
            name = chr(first + digit) + name
        names.append(name)
    return names


def site_prefix(weeks: DataFrame) -> DataFrame:
    """Cumulative postings per place in long form, however many weeks there are: ``week, total``.

    There is a row for a week with postings only; a place without any in week 0 or later has one row of
    week -1 with total 0. ``weeks`` may be counted already or hold one row per posting.
    """
    known = F.col("week") >= 0
    counted = weeks.groupBy(*PLACE, F.when(known, F.col("week")).otherwise(-1).cast("int").alias("week")).agg(
        F.sum(F.when(known, F.col("quantity")).otherwise(0)).alias("quantity")
    )
    upto = Window.partitionBy(*PLACE).orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(*PLACE, "week", F.sum("quantity").over(upto).cast("bigint").alias("total"))


def heat_range(index: DataFrame, lo: int, hi: int) -> DataFrame:
    """Postings of weeks ``lo`` to ``hi - 1`` per place, by one subtraction.

    In long form (:func:`site_prefix`, or :func:`site_index` in long form) both totals are those of the last week before
    the bound that has a row, found in one aggregate.
    """
    if "week" in index.columns:
        if not 0 <= lo <= hi:
            raise ValueError("need 0 <= lo <= hi")
        before = lambda bound: F.coalesce(F.max(F.when(F.col("week") < bound, F.col("total"))), F.lit(0))
        found = index.groupBy(*PLACE).agg((before(hi) - before(lo)).cast("bigint").alias("quantity"))
        return found.select("longitude", "latitude", "quantity")
    columns = [c for c in index.columns if c not in PLACE]
    if not 0 <= lo <= hi < len(columns):
        raise ValueError(f"need 0 <= lo <= hi <= {len(columns) - 1}")
    return index.select(
        "longitude", "latitude", (F.col(columns[hi]) - F.col(columns[lo])).alias("quantity")
    )
