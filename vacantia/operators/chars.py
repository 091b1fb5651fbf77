"""Character inventory, decisions about characters, and text normalisation by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: ASCII meaning of the classes -------------------------------------------------
SPECIAL = r"[^\w\s]"
BLANKS_AND_DIGITS = r"[\s\d]+"


def collapse_digits(c: Column) -> Column:
    """Runs of blanks and digits become one blank, none at the ends."""
    return F.btrim(F.regexp_replace(c, BLANKS_AND_DIGITS, " "))


def unclassified_chars(df: DataFrame, col: str, chars: DataFrame) -> DataFrame:
    """Characters that are neither word characters nor in the table, with their counts.

    Counted map-side, so what travels is one row per character and task.
    """
    found = df.select(
        F.explode(F.regexp_extract_all(F.col(col), F.lit(f"({SPECIAL})"), 1)).alias("ch")
    )
    counts = found.groupBy("ch").agg(F.count("*").alias("n"))
    return counts.join(chars.select("ch").distinct(), "ch", "left_anti")


def apply_decisions(chars: DataFrame, decisions: DataFrame) -> DataFrame:
    """The character table after decisions ``(ch, answer, decided_at)``; the latest one wins.

    An answer counts by its first letter, y or n in either case; any other leaves the character
    open.
    """
    letter = F.lower(F.substring(F.col("answer"), 1, 1))
    answered = decisions.filter(letter.isin("y", "n")).select(
        "ch", (letter == "y").alias("is_word"), F.lit(1).alias("stage"), "decided_at"
    )
    stored = chars.select(
        "ch",
        "is_word",
        F.lit(0).alias("stage"),
        F.lit(None).cast(decisions.schema["decided_at"].dataType).alias("decided_at"),
    )
    latest = F.max_by("is_word", F.struct("stage", "decided_at"))
    return stored.unionByName(answered).groupBy("ch").agg(latest.alias("is_word"))


def _members(chars: DataFrame) -> Column:
    """The table's characters as the inside of a character class, by a scalar subquery.

    It is at most as long as the alphabet, however large the text.
    """
    escaped = F.concat(F.lit(r"\x{"), F.hex(F.ascii("ch")), F.lit("}"))
    return chars.agg(F.array_join(F.sort_array(F.collect_set(escaped)), "")).scalar()


def normalise_text(
    df: DataFrame, col: str, chars: DataFrame, unknown: str = "keep", out: str | None = None
) -> DataFrame:
    """Blank digits and known non-word characters, keep known word characters, collapse blanks.

    ``unknown`` says what happens to characters the table does not hold: ``keep`` them, ``blank``
    them, or ``flag`` rows that have some in a column ``has_unclassified``. A text without any
    special character is only collapsed, whatever the table says. All that becomes a blank is one
    character class, so a text is rewritten in one pass.
    """
    if unknown not in ("keep", "blank", "flag"):
        raise ValueError(f"unknown is 'keep', 'blank' or 'flag', not {unknown!r}")
    text = F.col(col)
    known = _members(chars)
    open_chars = F.concat(
        F.lit(r"[\W&&\S"), F.when(known != "", F.concat(F.lit("&&[^"), known, F.lit("]"))).otherwise(""),
        F.lit("]"),
    )
    blanked = [F.lit(r"[\s\d"), _members(chars.filter(~F.col("is_word")))]
    if unknown == "blank":
        blanked.append(open_chars)
    rewritten = F.btrim(F.regexp_replace(text, F.concat(*blanked, F.lit("]+")), F.lit(" ")))
    columns = {out or col: F.when(text.rlike(SPECIAL), rewritten).otherwise(collapse_digits(text))}
    if unknown == "flag":
        columns["has_unclassified"] = F.regexp_like(text, open_chars)
    return df.withColumns(columns)
