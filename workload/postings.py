"""Every source's postings, normalised from landed payloads that the tables are turned into."""

from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.plans import (
    classify_amazon, classify_apple, classify_dice, classify_facebook, classify_indeed,
)
from workload import payloads as P
from workload.registry import query

WS = fixed.WHITESPACE


def strip(sql):
    return f"trim({sql}, '{WS}')"


def _shown(classified, *columns):
    """Outcome, reason and the named columns, flat: days as text, section lists as lines."""
    flat = {
        "date_posted": F.date_format("date_posted", "yyyy-MM-dd"),
        "time_scraped": F.col("time_scraped").cast("string"),
        "listings": F.array_join(
            F.transform(
                "listings",
                lambda s: F.concat(s["type"], F.lit(": "), F.array_join(s["elements"], " / ")),
            ),
            "\n",
        ),
    }
    # Records that were skipped or wait for their page are counted by the tally, not shown.
    shown = classified.filter(F.col("outcome").isin("accepted", "rejected"))
    return shown.select(
        "list_id", "outcome", "error_reason",
        flat["time_scraped"].alias("time_scraped"),
        *(flat.get(c, F.col(c)).alias(c) for c in columns),
    )


def _good(**columns):
    """SQL of the columns, NULL where there is an error."""
    columns = {"time_scraped": f"'{P.FETCHED}'", **columns}
    return ",\n".join(
        f"case when error_reason is null then {sql} end as {name}" for name, sql in columns.items()
    )


OUTCOME = "case when error_reason is null then 'accepted' else 'rejected' end as outcome, error_reason"


@query(f"""
    with listed as (
        select *, o_orderkey as k,
               case o_orderkey % 5 when 0 then 'US' when 1 then 'USA' when 3 then 'CA' end as code,
               case when o_custkey % 2 = 0 then 'US, NY' else 'CA, ON ' end as place
        from orders, (values (0), (1)) as t(term_no)
        where {P.TWO_TERMS.format('o_orderkey')}),
    first as (
        select *, row_number() over (partition by k order by term_no) as rn
        from listed where coalesce(code, place) like 'US%'),
    checked as (
        select *, case when k % 17 = 0 then 'title is missing'
                       when k % 19 = 0 then 'title is not text'
                       when k % 29 <> 0 and k % 23 = 0 then 'posted_date is not a date'
                  end as error_reason
        from first where rn = 1)
    select cast(k as varchar) as list_id, {OUTCOME}, {_good(
        job_id="cast(k as varchar)", title="o_orderpriority || ' ' || term_no",
        department="o_orderstatus", location="trim(place)",
        date_posted="case when k % 29 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end",
        url="'https://www.amazon.jobs/en/jobs/' || k || case when k % 2 = 0 then '/x' else '' end",
        role_description="cast(o_custkey as varchar)",
        listings="'Basic Qualifications: a ' || o_custkey || ' / b' || chr(10) || o_orderstatus "
                 "|| case when k % 3 <> 0 then chr(10) || 'Preferred Qualifications: none' else '' end",
    )}
    from checked
""")
def amazon_postings(spark, sf):
    return _shown(
        classify_amazon(P.amazon(spark, sf)), "job_id", "title", "department", "location",
        "date_posted", "url", "role_description", "listings",
    )


@query(f"""
    with listed as (
        select *, o_orderkey as k, row_number() over (partition by o_orderkey order by term_no) as rn
        from orders, (values (0), (1)) as t(term_no)
        where {P.TWO_TERMS.format('o_orderkey')}),
    checked as (
        select *, case when k % 17 <> 0 and k % 19 = 0 then 'postingTitle is not text'
                       when k % 17 = 0 or k % 37 = 0 then 'title or id is missing'
                       when k % 23 = 0 then 'reqOpenDt is not a date'
                       when k % 31 = 0 then 'jobfunction is missing'
                  end as error_reason
        from listed where rn = 1 and k % 41 <> 0)
    select cast(k as varchar) as list_id, {OUTCOME}, {_good(
        job_id="cast(k as varchar)", title="o_orderpriority",
        department="case when k % 43 = 0 then 'R&D ' else '' end || o_orderstatus || term_no",
        location="'Place ' || o_custkey || case when k % 2 = 0 then ', NY' else '' end",
        date_posted="strftime(o_orderdate, '%Y-%m-%d')",
        url="'https://jobs.apple.com/us/search#&ss=' || k",
        role_description="'c'",
        listings="case when k % 2 = 0 then 'Additional Requirements: ' || o_orderstatus || chr(10) "
                 "else '' end || case when k % 3 <> 0 then 'Education: none' || chr(10) else '' end "
                 "|| 'Qualifications: one / two ' || o_custkey",
    )}
    from checked
""")
def apple_postings(spark, sf):
    return _shown(
        classify_apple(P.apple(spark, sf)), "job_id", "title", "department", "location",
        "date_posted", "url", "role_description", "listings",
    )


@query(f"""
    with listed as (
        select *, doc_id as k, term_no = 1 and doc_id % 13 = 0 as no_id
        from documents, (values (0), (1)) as t(term_no)
        where {P.TWO_TERMS.format('doc_id')}),
    first as (
        select *, row_number() over (partition by k order by term_no) as rn
        from listed where k % 5 <> 0 and not no_id),
    checked as (
        select *, case when k % 7 = 0 then 'location has no brackets'
                       when k % 11 = 0 then 'apply link has no id' end as error_reason
        from first where rn = 1)
    select cast(k as varchar) as list_id, {OUTCOME}, {_good(
        job_id="'r' || k", title="'Title ' || k", department="source", location="'A, NY|B, CA'",
        url="'https://www.facebook.com/careers/jobs/' || k || '/'",
        company_intro="'Intro ' || lang",
        role_description="case when k % 3 = 0 then '' else " + strip("text") + " end",
        listings="'Lines: ' || array_to_string(list_transform(string_split(text, chr(10)), "
                 "lambda x: " + strip("x") + "), ' / ')",
    )}
    from checked
    union all
    select null, 'rejected', 'link has no id', null, null, null, null, null, null, null, null, null
    from listed where no_id
""")
def facebook_postings(spark, sf):
    return _shown(
        classify_facebook(P.facebook(spark, sf)), "job_id", "title", "department", "location", "url",
        "company_intro", "role_description", "listings",
    )


LINES = strip(
    "array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10))"
)


@query(f"""
    with listed as (
        select *, doc_id as k, row_number() over (partition by doc_id order by term_no) as rn
        from documents, (values (0), (1)) as t(term_no)
        where {P.TWO_TERMS.format('doc_id')}),
    checked as (
        select *, case when k % 17 <> 0 and k % 23 = 0 then 'date is not a date'
                       when k % 31 = 0 then 'company is not text' end as error_reason
        from listed where rn = 1 and k % 19 <> 0 and k % 29 <> 0)
    select cast(k as varchar) as list_id, {OUTCOME}, {_good(
        job_id="cast(k as varchar)", title="'Job ' || k || ' under ' || term_no", company="source",
        location="lang",
        date_posted="case when k % 17 <> 0 then strftime(date '2017-01-01' "
                    "+ cast(k % 1000 as integer), '%Y-%m-%d') end",
        url="'https://www.dice.com/jobs/detail/' || k", role_description=LINES, listings="''",
    )}
    from checked
    union all
    select null, 'rejected', 'detailUrl has no id', null, null, null, null, null, null, null, null, null
    from listed where k % 29 = 0
""")
def dice_postings(spark, sf):
    return _shown(
        classify_dice(P.dice(spark, sf)), "job_id", "title", "company", "location", "date_posted",
        "url", "role_description", "listings",
    )


@query(f"""
    with listed as (
        select *, doc_id as k, row_number() over (partition by doc_id order by term_no) as rn
        from documents, (values (0), (1)) as t(term_no)
        where {P.TWO_TERMS.format('doc_id')}),
    checked as (
        select *, case when k % 29 = 0 then 'url is missing' end as error_reason
        from listed where rn = 1 and (k % 19 <> 0 or k % 29 = 0))
    select cast(k as varchar) as list_id, {OUTCOME}, {_good(
        job_id="cast(k as varchar)", title="'Job ' || k || ' under ' || term_no",
        company="case when k % 31 = 0 then '' else ' ' || source end",
        location="case when k % 4 = 0 then 'Full place' when k % 2 = 0 then 'Short place' "
                 "when k % 3 = 0 then lang else '' end",
        date_posted="case when k % 17 <> 0 and k % 23 <> 0 then strftime(date '2017-01-01' "
                    "+ cast(k % 1000 as integer), '%Y-%m-%d') end",
        date_posted_raw="case when k % 17 <> 0 and k % 23 = 0 then 'today' end",
        url="'http://www.indeed.com/viewjob?jk=' || k",
        role_description=f"case when k % 5 = 0 then '' else {LINES} end",
        original_url="case when k % 5 <> 0 then 'http://www.indeed.com/rc/clk?jk=' || k || '&fr=1' "
                     "end",
    )}
    from checked
""")
def indeed_postings(spark, sf):
    return _shown(
        classify_indeed(P.indeed(spark, sf)), "job_id", "title", "company", "location",
        "date_posted", "date_posted_raw", "url", "role_description", "original_url",
    )
