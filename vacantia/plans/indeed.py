"""Postings from JSON search pages joined with HTML detail pages, description by table path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions import html as H
from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.functions.dates import rfc822_date, rfc822_day
from vacantia.functions.urls import resolve
from vacantia.plans import common
from vacantia.sources.landed import json_items, pages_of

SOURCE = "indeed"

# --- fixed values: ids, class and path of the pages ---------------------------------------------
CONTENT = "job-content"
CONTENT_PATH = ["tr", "td", "table", "tr", "td"]
ORIGINAL_LINK = "view_job_link"
SUMMARY = "job_summary"
PLACE_KEYS = ["formattedLocationFull", "formattedLocation", "city"]


def list_records(raw: DataFrame) -> DataFrame:
    items = json_items(pages_of(raw, SOURCE), "results")
    key = J.id_field(F.col("item"), "jobkey")
    # The url is needed to fetch the page, after the id has been claimed.
    link = J.text_field(F.col("item"), "url", required=True)
    return items.withColumns(
        {
            "list_id": key.value,
            "claim_problem": link.problem,
            "problem": F.coalesce(F.col("problem"), key.problem),
        }
    )


def _place(item) -> J.Field:
    """The first place key that is there, even if its value turns out null."""
    value, problem = F.lit(""), J.no_problem()
    for key in reversed(PLACE_KEYS):
        field, there = J.text_field(item, key), J.member(item, key).isNotNull()
        value = F.when(there, field.value).otherwise(value)
        problem = F.when(there, field.problem).otherwise(problem)
    return J.Field(value, problem)


def details(raw: DataFrame) -> DataFrame:
    pages = common.detail_pages(raw, SOURCE).withColumn("nodes", H.nodes(F.col("body")))
    nodes = F.col("nodes")
    steps = H.select(nodes, H.tagged("table", H.has_id(CONTENT)))
    for tag in CONTENT_PATH:
        steps = H.children(nodes, steps, tag, 1)
    pages = pages.withColumn("content", steps)
    content = F.col("content")
    links = H.inside(nodes, content, H.tagged("a", H.class_contains(ORIGINAL_LINK)))
    summary = F.filter(H.children(nodes, content, "span"), H.has_id(SUMMARY))
    return pages.select(
        "*",
        H.first_href(links).alias("original"),
        X.strip(H.text_of(nodes, summary, "\n")).alias("description"),
    ).drop("nodes", "content", "body")


def finish(joined: DataFrame) -> DataFrame:
    link = J.text_field(F.col("item"), "url", required=True)
    joined = joined.withColumn("link", link.value)
    item, original = F.col("item"), F.col("original")
    title = J.text_field(item, "jobtitle")
    place = _place(item)
    posted = J.text_field(item, "date")
    unread = rfc822_day(posted.value).isNull()
    day = rfc822_date(posted.value)
    day_problem = F.coalesce(
        posted.problem, F.when(~unread & day.isNull(), F.lit("date is not a date"))
    )
    page = F.coalesce(F.col("detail_url"), F.col("link"))
    return common.classified(
        joined,
        common.first_problem(title.problem, place.problem, day_problem),
        F.coalesce(F.to_json(item), F.col("page_body")),
        job_id=F.col("list_id"),
        title=X.strip(title.value),
        company=F.coalesce(F.try_variant_get(item, J.path_of("company"), "string"), F.lit("")),
        location=X.strip(place.value),
        date_posted=day,
        date_posted_raw=F.when(unread & (posted.value != ""), posted.value),
        time_scraped=F.col("detail_at"),
        url=F.col("link"),
        role_description=F.col("description"),
        original_url=F.when(original != "", resolve(page, original)),
        listings=common.no_listings(),
    )


PLAN = common.Plan(list_records, details, finish)
classify_indeed = PLAN.classify


def normalise_indeed(
    raw: DataFrame, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    return common.split_outcomes(classify_indeed(raw, seen), fixed.AGGREGATOR_COLUMNS)
