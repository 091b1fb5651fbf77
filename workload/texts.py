"""Dates, strings, URLs and text normalisation."""

from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions import dates as D
from vacantia.functions import text as X
from vacantia.functions import urls as U
from vacantia.operators import chars as C
from workload.registry import query, table

WS = fixed.WHITESPACE


def _written_dates(spark, sf, text):
    """Events with their day as text; every 11th is spoilt."""
    spoilt = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("n/a "), text)).otherwise(text)
    return table(spark, sf, "events", "event_id", "ts").select("event_id", spoilt.alias("text"))


EVENT_DAYS = """
    select event_id, case when event_id % 11 <> 0 then strftime(ts, '%Y-%m-%d') end as day
    from events
"""


def _iso(day):
    return F.date_format(day, "yyyy-MM-dd").alias("day")


@query(EVENT_DAYS)
def date_long_month(spark, sf):
    blanks = F.when(F.col("event_id") % 2 == 0, F.lit("  ")).otherwise(F.lit(" "))
    text = F.concat(
        F.date_format("ts", "MMMM"), blanks, F.date_format("ts", "d"), F.lit(", "),
        F.date_format("ts", "yyyy"),
    )
    rows = _written_dates(spark, sf, text)
    return rows.select("event_id", _iso(D.long_month_date(F.col("text"))))


@query("""
    select event_id, case when event_id % 11 <> 0 then strftime(ts, '%Y-%m-%d') end as day,
           case when event_id % 11 <> 0 then strftime(ts, '%d %b %Y') end as cut
    from events
""")
def date_rfc822(spark, sf):
    rows = _written_dates(spark, sf, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    text = F.col("text")
    return rows.select("event_id", _iso(D.rfc822_date(text)), D.rfc822_day(text).alias("cut"))


ORDER_DAYS = """
    select o_orderkey, case when o_orderkey % 11 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end
           as day
    from orders
"""


def _order_dates(spark, sf, text):
    spoilt = F.when(F.col("o_orderkey") % 11 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return orders.select("o_orderkey", spoilt.alias("text"))


@query(ORDER_DAYS)
def date_dmy(spark, sf):
    rows = _order_dates(spark, sf, F.upper(F.date_format("o_orderdate", "d-MMM-yyyy")))
    return rows.select("o_orderkey", _iso(D.day_month_date(F.col("text"))))


@query(ORDER_DAYS)
def date_iso(spark, sf):
    rows = _order_dates(spark, sf, F.date_format("o_orderdate", "yyyy-M-d"))
    return rows.select("o_orderkey", _iso(D.iso_date(F.col("text"))))


@query(f"""
    with parts as (
        select doc_id, list_filter(
            list_transform(string_split(text, chr(10)), lambda x: trim(x, '{WS}')),
            lambda x: length(x) > 0) as lines
        from documents)
    select doc_id, cast(len(lines) as bigint) as n, array_to_string(lines, chr(10)) as lines
    from parts
""")
def nonempty_lines(spark, sf):
    lines = table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.split_lines(F.col("text")).alias("lines")
    )
    return lines.select(
        "doc_id", F.size("lines").cast("bigint").alias("n"), F.array_join("lines", "\n").alias("lines")
    )


@query(f"""
    with parts as (
        select doc_id, list_filter(
            list_transform(string_split(trim(text, '{WS}'), chr(10)), lambda x: trim(x, '{WS}')),
            lambda x: length(x) > 0) as elements
        from documents)
    select doc_id, cast(len(elements) as bigint) as n, array_to_string(elements, chr(10)) as elements
    from parts
""")
def bullet_split(spark, sf):
    bulleted = F.concat(F.lit("• "), F.replace("text", F.lit("\n"), F.lit("<br/> • ")))
    elements = table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.split_bullets(bulleted).alias("elements")
    )
    return elements.select(
        "doc_id",
        F.size("elements").cast("bigint").alias("n"),
        F.array_join("elements", "\n").alias("elements"),
    )


@query("""
    select c_custkey,
           case when c_custkey % 5 <> 0 then c_name || '|' || c_mktsegment end as places,
           case when c_nationkey % 2 = 0 then c_name || ', ' || c_mktsegment else c_name end as place
    from customer
""")
def place_split(spark, sf):
    both = F.concat_ws(" - ", "c_name", "c_mktsegment")
    bracketed = F.when(
        F.col("c_custkey") % 5 != 0, F.concat(F.lit("("), both, F.lit(")"))
    ).otherwise(both)
    state = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    customers = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return customers.select(
        "c_custkey",
        X.joined_places(bracketed).alias("places"),
        X.place_with_state(F.col("c_name"), state).alias("place"),
    )


@query("""
    select page_id, cast(page_id as varchar) as path_id,
           page_id || '/' || url || '?src=1' as result_id,
           case when page_id % 3 <> 0 then 'r' || page_id end as request_id
    from pages
""")
def page_key(spark, sf):
    number = F.col("page_id").cast("string")
    request = F.concat(
        F.lit("/careers/resume?a=1&"),
        F.when(F.col("page_id") % 3 == 0, F.lit("rq=")).otherwise(F.lit("req=")),
        F.concat(F.lit("r"), number, F.lit("&b=2")),
    )
    result = F.concat(F.lit("http://www.dice.com/job/result/"), number, F.lit("/"), "url",
                      F.lit("?src=1?src=19"))
    return table(spark, sf, "pages", "page_id", "url").select(
        "page_id",
        U.path_id(F.concat(F.lit("/careers/jobs/"), number, F.lit("/?u="), "url")).alias("path_id"),
        U.result_id(result).alias("result_id"),
        U.request_id(request).alias("request_id"),
    )


CHARS = [(".", False), (",", False), ("!", False), ("|", False), ("*", False), ("+", True),
         ("#", True), ("é", True), ("è", True), ("-", False), ("]", False), ("\\", False),
         ("&", False), ("^", False), ("_", False), ("q", False)]


def _chars(spark):
    return spark.createDataFrame(CHARS, "ch string, is_word boolean")


@query("""
    select ch, count(*) as n
    from (select unnest(regexp_extract_all(text, '[^0-9A-Za-z_ \t\n\x0b\f\r]')) as ch
          from documents)
    where ch not in ('.', ',', '!', '|', '*', '+', '#', 'é', 'è', '-', ']', '\\', '&', '^', '_', 'q')
    group by ch
""")
def char_report(spark, sf):
    docs = table(spark, sf, "documents", "text")
    return C.unclassified_chars(docs, "text", _chars(spark))


NORMALISED = """
    with base as (
        select doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r0-9]+', ' ', 'g')) as text
        from documents),
    swapped as (
        select doc_id, text as base, regexp_replace(text, '[.,!|*\\]\\\\&^_q-]', ' ', 'g') as text
        from base)
    select doc_id, case when regexp_matches(base, '[^0-9A-Za-z_ \t\n\x0b\f\r]')
                        then trim(regexp_replace({text}, '[ \t\n\x0b\f\r]+', ' ', 'g'))
                        else base end as text{flag}
    from swapped
"""


@query(NORMALISED.format(text="text", flag=""))
def text_normalised(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return C.normalise_text(docs, "text", _chars(spark))


@query(NORMALISED.format(
    text="regexp_replace(text, '[^0-9A-Za-z_+#éè \t\n\x0b\f\r]', ' ', 'g')", flag=""))
def text_normalised_blank(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return C.normalise_text(docs, "text", _chars(spark), unknown="blank")


@query(NORMALISED.format(
    text="text",
    flag=", regexp_matches(text, '[^0-9A-Za-z_+#éè \t\n\x0b\f\r]') as has_unclassified"))
def text_normalised_flag(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return C.normalise_text(docs, "text", _chars(spark), unknown="flag")
