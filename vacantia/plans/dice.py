"""Postings from JSON search pages joined with HTML detail pages, description by element id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions import html as H
from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.functions.dates import iso_date
from vacantia.functions.urls import detail_url, result_id
from vacantia.plans import common
from vacantia.sources.landed import json_items, pages_of

SOURCE = "dice"

# --- fixed value: element id of the description -------------------------------------------------
DESCRIPTION = "jobdescSec"


def list_records(raw: DataFrame) -> DataFrame:
    items = json_items(pages_of(raw, SOURCE), "resultItemList")
    link = J.text_field(F.col("item"), "detailUrl", required=True)
    key = result_id(link.value)
    return items.select(
        "*",
        link.value.alias("link"),
        key.alias("list_id"),
        F.coalesce(
            link.problem, F.when(key.isNull(), F.lit("detailUrl has no id"))
        ).alias("item_problem"),
    ).withColumn("problem", F.coalesce("problem", "item_problem")).drop("item_problem")


def details(raw: DataFrame) -> DataFrame:
    pages = common.detail_pages(raw, SOURCE).withColumn("nodes", H.nodes(F.col("body")))
    nodes = F.col("nodes")
    found = H.select(nodes, H.tagged("div", H.has_id(DESCRIPTION)))
    text = X.strip(H.text_of(nodes, found, "\n"))
    return pages.withColumn("description", text).drop("nodes", "body")


def finish(joined: DataFrame) -> DataFrame:
    item = F.col("item")
    title = J.text_field(item, "jobTitle")
    company = J.text_field(item, "company")
    place = J.text_field(item, "location")
    day, day_problem = J.date_field(J.text_field(item, "date"), iso_date, "date")
    return common.classified(
        joined,
        common.first_problem(title.problem, place.problem, day_problem, company.problem),
        F.coalesce(F.to_json(item), F.col("page_body")),
        job_id=F.col("list_id"),
        title=X.strip(title.value),
        company=X.strip(company.value),
        location=X.strip(place.value),
        date_posted=day,
        time_scraped=F.col("detail_at"),
        url=F.coalesce(F.col("detail_url"), detail_url(F.col("link"))),
        role_description=F.col("description"),
        listings=common.no_listings(),
    )


PLAN = common.Plan(list_records, details, finish)
classify_dice = PLAN.classify


def normalise_dice(
    raw: DataFrame, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    return common.split_outcomes(classify_dice(raw, seen), fixed.AGGREGATOR_COLUMNS)
