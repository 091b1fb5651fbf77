"""String helpers, Column in and Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia import fixed


def strip(c: Column) -> Column:
    """Remove blanks of every kind at both ends (``trim`` alone removes spaces only)."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def _stripped_parts(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: F.length(x) > 0)


def split_lines(c: Column) -> Column:
    """Lines of a text, stripped, empty ones dropped."""
    return _stripped_parts(F.split(c, "\n"))


def split_bullets(c: Column, literal: bool = False) -> Column:
    """Elements of a bulleted HTML text, without bullets, stripped, empty ones dropped.

    ``literal=True`` splits only at the escape sequence spelt out, so that a real bullet does not
    split.
    """
    pattern = fixed.LITERAL_BULLET_BREAK if literal else fixed.BULLET_BREAK
    parts = F.split(strip(c), pattern)
    return _stripped_parts(
        F.transform(parts, lambda x: F.replace(x, F.lit(fixed.BULLET), F.lit("")))
    )


def places(c: Column) -> Column:
    """``(A - B)`` as an array of places, NULL where the brackets are missing."""
    inner = F.regexp_extract(c, fixed.PLACES_PATTERN, 1)
    return F.when(c.rlike(fixed.PLACES_PATTERN), F.split(inner, fixed.PLACES_SEPARATOR))


def joined_places(c: Column) -> Column:
    """``(A - B)`` as ``A|B``, NULL where the brackets are missing."""
    return F.array_join(places(c), "|")


def place_with_state(name: Column, state: Column) -> Column:
    return F.when(F.length(state) > 0, F.concat(name, F.lit(", "), state)).otherwise(name)


def in_country(c: Column, prefix: str = fixed.COUNTRY_PREFIX) -> Column:
    return c.startswith(prefix)


def names_a_state(c: Column) -> Column:
    """True where the place holds a comma and two capitals, anywhere in the text."""
    return c.rlike(fixed.PLACE_PATTERN)


def first_match(c: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL where the pattern does not occur."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))
