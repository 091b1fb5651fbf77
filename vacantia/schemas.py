"""Schemas of landed and stored tables."""

from pyspark.sql import types as T

from vacantia import fixed

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType()}


def plain(columns: str) -> T.StructType:
    """A schema from names and types, which needs no session."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (c.split() for c in columns.split(", "))])


LISTINGS = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("elements", T.ArrayType(T.StringType())),
        ]
    )
)

RAW = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("query_term", T.StringType()),
        T.StructField("term_no", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("list_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("body", T.StringType()),
    ]
)

_TYPED = {
    "date_posted": T.DateType(),
    "time_scraped": T.TimestampNTZType(),
    "listings": LISTINGS,
}


def _posting(columns):
    return T.StructType([T.StructField(c, _TYPED.get(c, T.StringType())) for c in columns])


POSTING = _posting(fixed.JOB_COLUMNS)
AGGREGATOR_POSTING = _posting(fixed.AGGREGATOR_COLUMNS)

# What the engine keeps per posting: the widest column list, where it came from, the id it was
# listed under, and the date text wherever it could not be read as a date.
STORED_POSTING = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("list_id", T.StringType()),
        *AGGREGATOR_POSTING.fields,
        T.StructField("date_posted_raw", T.StringType()),
    ]
)

SEEN = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("job_id", T.StringType())]
)

COMPANY_SITE = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

AGGREGATOR_SITE = T.StructType(
    [
        T.StructField("date_posted", T.DateType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

CHARS = T.StructType(
    [T.StructField("ch", T.StringType()), T.StructField("is_word", T.BooleanType())]
)

COMPANY_COLUMNS = fixed.COMPANY_COLUMNS
COMPANY = T.StructType([T.StructField(c, T.StringType()) for c in COMPANY_COLUMNS])
