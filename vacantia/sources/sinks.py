"""CSV files for other tools."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia import fixed, schemas
from vacantia.sources import files

#: Rows of one file at most: files with line breaks in texts are read by one task each.
FILE_ROWS = 250_000


def _as_text(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        exact = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(exact.endswith(".000000"), whole).otherwise(exact)
    return c.cast("string")


def filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in order as text, ``''`` for anything missing.

    A date that could not be read is written as it was.
    """
    out = []
    for name in columns:
        texts = [_as_text(df, name)] if name in df.columns else []
        if f"{name}_raw" in df.columns:
            texts.append(F.col(f"{name}_raw"))
        out.append(F.coalesce(*texts, F.lit("")).alias(name))
    return df.select(*out)


def export_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Write CSV with a header, quoting only where needed, quotes doubled.

    Rows end with a plain line feed: the writer would turn every line feed inside a text into
    whatever longer row end it is given. To overwrite, all is written beside and then put in the place of what
    was there, which a write that fails leaves as it is.
    """
    spark, whole = df.sparkSession, mode == "overwrite"
    at = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}" if whole else path
    (
        filled(df, columns)
        .write.mode("errorifexists" if whole else mode)
        .option("header", True)
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(at)
    )
    if whole:
        files.replace(spark, at, path)


def export_postings(postings: DataFrame, path: str, mode: str = "append") -> None:
    export_csv(postings, path, fixed.JOB_COLUMNS, mode)


def export_aggregator_postings(postings: DataFrame, path: str, mode: str = "append") -> None:
    export_csv(postings, path, fixed.AGGREGATOR_COLUMNS, mode)


def export_companies(companies: DataFrame, path: str) -> None:
    export_csv(companies, path, schemas.COMPANY_COLUMNS, "overwrite")
