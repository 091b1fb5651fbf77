"""Company profiles from nested JSON list pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia import fixed, schemas
from vacantia.functions import json as J
from vacantia.sources.landed import json_items, pages_of

SOURCE = "companies"


def classify_companies(raw: DataFrame) -> DataFrame:
    """Profile columns, reason and record of every list entry. No entry is ever a duplicate."""
    items = json_items(pages_of(raw, SOURCE), "list-items")
    item = F.col("item")
    meta, linked = J.member(item, "meta"), J.member(item, "companies")
    head = J.member(item, "companies", 0)
    problem = F.coalesce(
        F.col("problem"),
        F.when(~J.is_object(item), F.lit("record is not an object")),
        F.when(meta.isNotNull() & ~J.is_object(meta), F.lit("meta is not an object")),
        F.when(linked.isNotNull() & ~J.is_list(linked), F.lit("companies is not a list")),
        F.when(linked.isNotNull() & head.isNull(), F.lit("companies is empty")),
        F.when(head.isNotNull() & ~J.is_object(head), F.lit("company is not an object")),
    )
    paths = {name: ("meta", name) for name in fixed.COMPANY_META}
    paths |= {name: (key,) for key, name in fixed.COMPANY_ROOT}
    paths |= {name: ("companies", 0, key) for key, name in fixed.COMPANY_LINKED}
    return items.select(
        *(J.printed(J.member(item, *paths[c])).alias(c) for c in schemas.COMPANY_COLUMNS),
        "source",
        problem.alias("error_reason"),
        F.when(
            problem.isNotNull(), F.coalesce(F.to_json(item), "page_body")
        ).alias("record"),
    )


def flatten_companies(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(profiles, rejected)``"""
    rows = classify_companies(raw)
    good = F.col("error_reason").isNull()
    profiles = rows.filter(good).select(*(F.col(f"`{c}`") for c in schemas.COMPANY_COLUMNS))
    return profiles, rows.filter(~good).select("source", "error_reason", "record")


# --- fixed values: which profile columns hold numbers -------------------------------------------
NUMBERS = [
    "ranking", "prevrank", "yearsonlist", "employees", "jobgrowthnum", "assets", "mktval",
    "totshequity", "revenues", "revchange", "eps", "epschange", "eps10yr", "eps5yr", "profits",
    "prftchange", "prftpctasts", "prftpctseqty", "prftpctsls", "totrti", "totrti5yr", "totrti10yr",
]


def typed_companies(profiles: DataFrame) -> DataFrame:
    """Profiles with their figures as numbers; text that is no number becomes NULL."""
    return profiles.select(
        *(
            F.regexp_replace(f"`{c}`", "[$,%]", "").try_cast("double").alias(c)
            if c in NUMBERS
            else F.col(f"`{c}`")
            for c in schemas.COMPANY_COLUMNS
        )
    )
