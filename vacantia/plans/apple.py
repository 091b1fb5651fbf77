"""Postings from XML search pages joined with JSON detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia import fixed, schemas
from vacantia.functions import html as H
from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.functions.dates import day_month_date
from vacantia.functions.urls import posting_url
from vacantia.plans import common
from vacantia.sources.landed import array_items, pages_of

SOURCE = "apple"
# --- fixed values: elements of the list pages, as the reader gives them, in lower case -----------
COUNT, RECORD, RECORD_FIELDS = "count", "requisition", ("jobid", "jobfunction")


def list_records(raw: DataFrame) -> DataFrame:
    """Records of the XML lists, read as tolerantly as HTML: a bare ``&`` or a cut page costs nothing else."""
    pages = pages_of(raw, SOURCE).withColumn("nodes", H.nodes(F.col("body")))
    nodes = F.col("nodes")
    field = lambda r, tag: H.text_of_first(nodes, F.filter(H.below(nodes, r), H.tagged(tag)))
    entries = F.transform(
        H.select(nodes, H.tagged(RECORD)),
        lambda r: F.struct(*(field(r, tag).alias(tag) for tag in RECORD_FIELDS)),
    )
    counts = H.select(nodes, H.tagged(COUNT))
    problem = (
        F.when(F.coalesce(F.forall(nodes, H.is_text), F.lit(True)), F.lit("body is not XML"))
        .when(F.size(counts) == 0, F.lit("count is missing"))
        .when(F.trim(H.text_of_first(nodes, counts)).try_cast("bigint").isNull(), F.lit("count is not a number"))
    )
    items = array_items(pages, entries, problem)
    key = F.when(F.col("item.jobid") != "", F.col("item.jobid"))
    return items.withColumn("list_id", key).withColumn(
        "problem",
        F.coalesce("problem", F.when(key.isNull(), F.lit("jobid is missing"))),
    )


def section_texts(doc: Column, *at: str) -> Column:
    """Texts under known keys, by key, NULL where there is anything but text."""
    made = []
    for key, label in sorted(fixed.APPLE_SECTIONS):
        text = F.try_variant_get(doc, J.path_of(*at, key), "string")
        shown = F.when(J.is_text(J.member(doc, *at, key)), text)
        made.append(F.struct(F.lit(label).alias("type"), shown.alias("text")))
    return F.array(*made)


def sections_of(texts: Column) -> Column:
    """Sections of :func:`section_texts`; those without text are left out."""
    found = F.filter(texts, lambda s: s["text"].isNotNull())
    made = F.transform(
        found, lambda s: F.struct(s["type"].alias("type"), X.split_lines(X.strip(s["text"])).alias("elements"))
    )
    return made.cast(schemas.LISTINGS)


def sections(doc: Column, *at: str) -> Column:
    """Text sections under known keys, by key; sections of any other kind are left out."""
    return sections_of(section_texts(doc, *at))


def details(raw: DataFrame) -> DataFrame:
    """Fields of the detail pages; a page that cannot be read keeps its body with the problem."""
    pages = common.detail_pages(raw, SOURCE).withColumn("doc", F.try_parse_json("body"))
    doc = F.col("doc")
    info = J.member(doc, "requisitionInfo")
    fields = J.member(doc, "reqTextFields")
    title = J.text_field(doc, "requisitionInfo", "postingTitle")
    form = J.member(doc, "requisitionInfo", "formId")
    form_id = F.try_variant_get(doc, J.path_of("requisitionInfo", "formId"), "string")
    place = J.text_field(doc, "requisitionInfo", "locationName")
    state = J.text_field(doc, "requisitionInfo", "stateAbbr")
    opened = J.text_field(doc, "requisitionInfo", "reqOpenDt")
    # What is used more than once, or within a function over an array, is a column first: it is computed once, in
    # compiled code.
    pages = pages.withColumns({"day": day_month_date(opened.value), "texts": section_texts(doc, "reqTextFields")})
    day, day_problem = J.date_field(opened, lambda _: F.col("day"), "reqOpenDt")
    comments = J.text_field(doc, "jobComments")
    zero = ~J.is_text(form) & (form_id.try_cast("double") == 0)
    problem = F.coalesce(
        F.when(doc.isNull(), F.lit("body is not JSON")),
        F.when(~J.is_object(doc), F.lit("body is not an object")),
        F.when(info.isNotNull() & ~J.is_object(info), F.lit("requisitionInfo is not an object")),
        title.problem,
        F.when(
            (title.value == "") | form.isNull() | F.coalesce(zero, F.lit(False)),
            F.lit("title or id is missing"),
        ),
        F.when(form_id.isNull(), F.lit("formId is null")),
        place.problem,
        state.problem,
        day_problem,
        comments.problem,
        F.when(fields.isNotNull() & ~J.is_object(fields), F.lit("reqTextFields is not an object")),
    )
    return pages.select(
        *(c for c in pages.columns if c not in ("day", "texts")),
        problem.alias("detail_problem"),
        form_id.alias("job_id"),
        X.strip(title.value).alias("title"),
        X.strip(X.place_with_state(place.value, state.value)).alias("place"),
        day.alias("day"),
        X.strip(comments.value).alias("comments"),
        sections_of(F.col("texts")).alias("listings"),
    ).withColumn("body", F.when(F.col("detail_problem").isNotNull(), F.col("body"))).drop("doc")


def finish(joined: DataFrame) -> DataFrame:
    function = F.when(F.col("item.jobfunction") != "", F.col("item.jobfunction"))
    return common.classified(
        joined,
        common.first_problem(
            F.col("detail_problem"),
            F.when(function.isNull(), F.lit("jobfunction is missing")),
        ),
        F.coalesce("body", F.to_json("item"), "page_body"),
        job_id=F.col("job_id"),
        title=F.col("title"),
        department=X.strip(function),
        location=F.col("place"),
        date_posted=F.col("day"),
        time_scraped=F.col("detail_at"),
        url=posting_url(F.col("job_id")),
        role_description=F.col("comments"),
        listings=F.col("listings"),
    )


PLAN = common.Plan(list_records, details, finish)
classify_apple = PLAN.classify


def normalise_apple(
    raw: DataFrame, seen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    return common.split_outcomes(classify_apple(raw, seen), fixed.JOB_COLUMNS)
