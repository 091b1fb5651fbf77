"""Postings from HTML search pages joined with HTML detail pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia import fixed, schemas
from vacantia.functions import html as H
from vacantia.functions import text as X
from vacantia.functions.urls import path_id, request_id, resolve
from vacantia.plans import common
from vacantia.sources.landed import array_items, pages_of

SOURCE = "facebook"

# --- fixed values: class names and ids of the pages ---------------------------------------------
CARD = "_3k6i"
CARD_LINK = "_5144"
CARD_PLACE = "_3k6n"
TOPIC = "_35i2"
CONTENT = "_4ycv"
TITLE = "_4ycw"
PLACE = "_4ycx"
SECTION = "_wrz"
APPLY_LINK = "u_0_d"


def list_records(raw: DataFrame) -> DataFrame:
    pages = pages_of(raw, SOURCE).withColumn("nodes", H.nodes(F.col("body")))
    nodes = F.col("nodes")
    cards = F.transform(
        H.select(nodes, H.tagged("div", H.has_class(CARD))),
        lambda card: F.struct(
            H.first_href(
                F.filter(H.below(nodes, card), H.tagged("a", H.class_contains(CARD_LINK)))
            ).alias("link"),
            H.text_of(
                nodes,
                F.filter(H.below(nodes, card), H.tagged("div", H.class_contains(CARD_PLACE))),
            ).alias("place"),
        ),
    )
    items = array_items(pages, cards)
    key = path_id(F.col("item.link"))
    return items.withColumn("list_id", key).withColumn(
        "problem",
        F.coalesce("problem", F.when(key.isNull(), F.lit("link has no id"))),
    )


def listed(raw: DataFrame) -> DataFrame:
    """Records whose place names a state, and records with a problem; the others are only counted."""
    records = list_records(raw)
    named = F.coalesce(X.names_a_state(F.col("item.place")), F.lit(False))
    return records.withColumn(
        "skip", F.when(F.col("problem").isNull() & ~named, F.lit("skipped_place"))
    )


def details(raw: DataFrame) -> DataFrame:
    """Fields of the detail pages; a page that cannot be read keeps its body with the problem."""
    pages = common.detail_pages(raw, SOURCE).withColumn("nodes", H.nodes(F.col("body")))
    nodes = F.col("nodes")
    pages = pages.withColumn("content", H.select(nodes, H.tagged("div", H.has_class(CONTENT))))
    content = F.col("content")
    topic = H.select(nodes, H.tagged("div", H.class_contains(TOPIC)))
    described = F.filter(H.children(nodes, content, "div", 3), H.class_other_than(SECTION))
    listings = F.transform(
        H.inside(nodes, content, H.tagged("div", H.has_class(SECTION))),
        lambda section: F.struct(
            X.strip(
                H.text_of(nodes, F.filter(H.below(nodes, section), H.tagged("h4")))
            ).alias("type"),
            F.transform(
                H.children(
                    nodes, F.filter(H.below(nodes, section), H.tagged("ul")), "li"
                ),
                lambda element: X.strip(H.text_below(nodes, element)),
            ).alias("elements"),
        ),
    )
    places = H.inside(nodes, content, H.tagged("div", H.class_contains(PLACE)))
    apply_link = H.inside(nodes, content, H.tagged("a", H.has_id(APPLY_LINK)))
    read = pages.select(
        "*",
        X.strip(H.text_of(nodes, H.inside(nodes, content, H.class_contains(TITLE)))).alias("title"),
        X.strip(H.text_of(nodes, topic)).alias("topic"),
        X.joined_places(H.text_of(nodes, places)).alias("places"),
        request_id(H.first_href(apply_link)).alias("job_id"),
        X.strip(H.text_of(nodes, H.children(nodes, content, "div", 2))).alias("intro"),
        X.strip(H.text_of(nodes, described)).alias("description"),
        listings.cast(schemas.LISTINGS).alias("listings"),
    ).drop("nodes", "content")
    problem = F.coalesce(
        F.when(F.col("places").isNull(), F.lit("location has no brackets")),
        F.when(F.col("job_id").isNull(), F.lit("apply link has no id")),
    )
    return read.withColumn("detail_problem", problem).withColumn(
        "body", F.when(F.col("detail_problem").isNotNull(), F.col("body"))
    )


def finish(joined: DataFrame) -> DataFrame:
    return common.classified(
        joined,
        common.first_problem(F.col("detail_problem")),
        F.coalesce("body", F.to_json("item"), "page_body"),
        job_id=F.col("job_id"),
        title=F.col("title"),
        department=F.col("topic"),
        location=X.strip(F.col("places")),
        time_scraped=F.col("detail_at"),
        url=F.coalesce(F.col("detail_url"), resolve(F.col("url"), F.col("item.link"))),
        company_intro=F.col("intro"),
        role_description=F.col("description"),
        listings=F.col("listings"),
    )


PLAN = common.Plan(listed, details, finish)
classify_facebook = PLAN.classify


def normalise_facebook(
    raw: DataFrame, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    return common.split_outcomes(classify_facebook(raw, seen), fixed.JOB_COLUMNS)
