"""Date formats of the sources. Each returns NULL where the text is not a date of that format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions.text import first_match


def _parsed(c: Column, shape: str, fmt: str) -> Column:
    tidy = F.ltrim(F.regexp_replace(c, r"\s+", " "))
    return F.when(c.rlike(shape), F.try_to_date(tidy, fmt))


def long_month_date(c: Column) -> Column:
    """``February 9, 2017``; any run of blanks counts as one."""
    return _parsed(c, r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$", "MMMM d, yyyy")


def day_month_date(c: Column) -> Column:
    """``09-Feb-2017``"""
    return _parsed(c, r"^ ?\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy")


def iso_date(c: Column) -> Column:
    """``2017-02-09``, also without leading zeros."""
    return _parsed(c, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d")


def rfc822_day(c: Column) -> Column:
    """The ``25 Jan 2017`` part of ``Wed, 25 Jan 2017 17:41:20 GMT``, NULL where there is none."""
    return first_match(c, fixed.RFC822_DATE)


def rfc822_date(c: Column) -> Column:
    return _parsed(rfc822_day(c), r"^\d{1,2}\s+[A-Za-z]{3}\s+\d{4}$", "d MMM yyyy")


def site_date(c: Column) -> Column:
    """Date column of a site file: ``-`` or ``/`` between the parts, anything after ignored."""
    shape = r"^\s*(\d{4}[-/]\d{1,2}[-/]\d{1,2})"
    return F.try_to_date(F.translate(first_match(c, shape), "/", "-"), "yyyy-M-d")


def week_age(newest: Column, day: Column) -> Column:
    """Whole weeks between a day and the newest one, cut towards zero."""
    return (F.date_diff(newest, day) / F.lit(7)).cast("int")
