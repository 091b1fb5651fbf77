"""Postings from JSON search pages that hold the whole record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia import fixed, schemas
from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.functions.dates import long_month_date
from vacantia.functions.urls import resolve
from vacantia.plans import common
from vacantia.sources.landed import json_items, pages_of

SOURCE = "amazon"


def _hits_problem(doc: Column) -> Column:
    hits = J.member(doc, "hits")
    number = F.try_variant_get(doc, J.path_of("hits"), "bigint")
    return F.when(hits.isNotNull() & number.isNull(), F.lit("hits is not a number"))


def sections(item: Column, literal: bool) -> tuple[Column, list[Column]]:
    """Labelled sections that are there, in fixed order, and the problems of those that are bad."""
    made, problems = [], []
    for key, label in fixed.AMAZON_SECTIONS:
        field = J.text_field(item, key)
        section = F.struct(
            F.lit(label).alias("type"), X.split_bullets(field.value, literal).alias("elements")
        )
        made.append(F.when(J.member(item, key).isNotNull(), section))
        problems.append(field.problem)
    return F.array_compact(F.array(*made)).cast(schemas.LISTINGS), problems


def list_records(raw: DataFrame) -> DataFrame:
    """Records of the search pages with their id, the country that decides, and early problems."""
    items = json_items(pages_of(raw, SOURCE), "jobs", _hits_problem)
    item = F.col("item")
    code = J.member(item, "country_code")
    use_place = code.isNull() | F.is_variant_null(code)
    country = J.text_field(item, "country_code")
    place = J.text_field(item, "location")
    key = J.id_field(item, "id")
    deciding = F.when(use_place, place.value).otherwise(country.value)
    country_problem = F.when(use_place, place.problem).otherwise(country.problem)
    early = F.when(~J.is_object(item), F.lit("record is not an object"))
    # A record outside the country is dropped before its id is looked at.
    return items.select(
        "*",
        F.when(F.col("problem").isNotNull(), F.lit(None)).otherwise(deciding).alias("country"),
        F.coalesce("problem", early, country_problem).alias("country_problem"),
        key.value.alias("list_id"),
        key.problem.alias("id_problem"),
    )


def listed(raw: DataFrame) -> DataFrame:
    """Records of the country, records whose country cannot be told, and the others to be counted."""
    records = list_records(raw)
    inside = F.col("country_problem").isNotNull() | F.coalesce(X.in_country(F.col("country")), F.lit(False))
    return (
        records.withColumn("skip", F.when(~inside, F.lit("skipped_place")))
        .withColumn("problem", F.coalesce("country_problem", "id_problem"))
        .drop("country", "country_problem", "id_problem")
    )


def finish(claimed: DataFrame, split_bullets: bool = True) -> DataFrame:
    item = F.col("item")
    title = J.text_field(item, "title", required=True)
    place = J.text_field(item, "location")
    department = J.text_field(item, "job_category")
    description = J.text_field(item, "description")
    posted = J.text_field(item, "posted_date")
    day, day_problem = J.date_field(posted, long_month_date, "posted_date")
    icims = J.text_field(item, "id_icims")
    path = J.member(item, "job_path")
    path_text = J.text_field(item, "job_path")
    path_problem = F.when(~F.is_variant_null(path), path_text.problem)
    ref = F.when(path.isNull(), F.concat(F.lit(fixed.AMAZON_JOB_PATH), icims.value)).otherwise(
        path_text.value
    )
    listings, section_problems = sections(item, literal=not split_bullets)
    return common.classified(
        claimed,
        common.first_problem(
            title.problem, place.problem, day_problem, department.problem, description.problem,
            icims.problem, path_problem, *section_problems,
        ),
        F.coalesce(F.to_json(item), F.col("page_body")),
        job_id=F.col("list_id"),
        title=X.strip(title.value),
        department=X.strip(department.value),
        location=X.strip(place.value),
        date_posted=day,
        time_scraped=F.col("fetched_at"),
        url=resolve(F.col("url"), ref),
        role_description=X.strip(description.value),
        listings=listings,
    )


PLAN = common.Plan(listed, None, finish)
classify_amazon = PLAN.classify


def normalise_amazon(
    raw: DataFrame, seen: DataFrame | None = None, split_bullets: bool = True
) -> tuple[DataFrame, DataFrame]:
    return common.split_outcomes(
        classify_amazon(raw, seen, split_bullets=split_bullets), fixed.JOB_COLUMNS
    )
