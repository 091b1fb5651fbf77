"""Landed payloads derived from the tables, in the layout each source delivers.

List pages hold at most a hundred records each, as the sources page them. Some are broken in ways
that a tolerant reader takes: a bare ``&``, a page that ends early.
"""

from pyspark.sql import functions as F

from vacantia import schemas
from workload.registry import table

PAGE_SIZE = 100
FETCHED = "2024-05-01 10:00:00"


def raw(df, source, kind, body, *, url, list_id=None, term_no=None, page=None):
    """Rows of the landed table."""
    values = {
        "source": F.lit(source),
        "kind": F.lit(kind),
        "query_term": F.concat(F.lit("term "), term_no if term_no is not None else F.lit("")),
        "term_no": term_no if term_no is not None else F.lit(None),
        "page": page if page is not None else F.lit(0),
        "pos": F.lit(0),
        "list_id": list_id if list_id is not None else F.lit(None),
        "url": url,
        "fetched_at": F.lit(FETCHED),
        "body": body,
    }
    return df.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in schemas.RAW.fields))


def spread(df):
    """Rows dealt out evenly. A table here is one row group, hence one task; pages land in many
    files, so this stands in for their layout and is no part of the plans under test."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def list_pages(records, source, start, separator, end, url):
    """Pages from rows ``(term_no, number, text)``, in order of the number."""
    page = (F.col("number") / PAGE_SIZE).cast("int").alias("page")
    pages = records.groupBy("term_no", page).agg(
        F.array_sort(F.collect_list(F.struct("number", "text"))).alias("entries")
    )
    texts = F.transform("entries", lambda e: e["text"])
    body = F.concat(F.lit(start), F.array_join(texts, separator), F.lit(end))
    return raw(
        pages, source, "list", body, url=F.lit(url), term_no=F.col("term_no"), page=F.col("page")
    )


def two_terms(df, number):
    """Each record under term 0, term 1 or both: three in four and one in two."""
    terms = df.withColumn("term_no", F.explode(F.array(F.lit(0), F.lit(1))))
    return terms.filter(
        F.when(F.col("term_no") == 0, F.col(number) % 4 != 3).otherwise(F.col(number) % 2 == 1)
    )


TWO_TERMS = "(term_no = 0 and {0} % 4 <> 3 or term_no = 1 and {0} % 2 = 1)"

NULL = "@null@"


def json_object(**members):
    """A JSON object; a NULL member is left out, the text ``@null@`` becomes a JSON null."""
    made = F.to_json(F.struct(*(c.alias(name) for name, c in members.items())))
    return F.replace(made, F.lit(f'"{NULL}"'), F.lit("null"))


def every(number, n, c, otherwise=None):
    """``c`` for every n-th row, else ``otherwise`` (NULL if not given)."""
    return F.when(F.col(number) % n == 0, c).otherwise(
        F.lit(None) if otherwise is None else otherwise
    )


def markup(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def amazon(spark, sf):
    orders = table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        "o_orderdate",
    )
    k = "o_orderkey"
    number = F.col(k).cast("string")
    country = (
        F.when(F.col(k) % 5 == 0, F.lit("US"))
        .when(F.col(k) % 5 == 1, F.lit("USA"))
        .when(F.col(k) % 5 == 3, F.lit("CA"))
        .when(F.col(k) % 5 == 4, F.lit(NULL))
    )
    title = F.concat(F.lit(" "), "o_orderpriority", F.lit(" "), F.col("term_no"), F.lit("\n"))
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    basic = F.concat(
        F.lit("• a "), "o_custkey", F.lit("<br/> • b\n"), "o_orderstatus", F.lit("<br/>•")
    )
    text = json_object(
        id=number,
        title=F.when(F.col(k) % 17 != 0, every(k, 19, F.lit(NULL), title)),
        country_code=country,
        location=F.when(F.col("o_custkey") % 2 == 0, F.lit("US, NY")).otherwise(F.lit("CA, ON ")),
        posted_date=F.when(F.col(k) % 29 != 0, every(k, 23, F.lit("soon"), day)),
        job_category=F.col("o_orderstatus"),
        description=F.concat(F.lit("\t"), F.col("o_custkey"), F.lit(" ")),
        id_icims=number,
        job_path=every(k, 2, F.concat(F.lit("/en/jobs/"), number, F.lit("/x"))),
        basic_qualifications=basic,
        preferred_qualifications=F.when(F.col(k) % 3 != 0, F.lit("none")),
    )
    records = two_terms(orders, k).select("term_no", F.col(k).alias("number"), text.alias("text"))
    return list_pages(
        records, "amazon", '{"hits":100,"jobs":[', ",", "]}", "https://www.amazon.jobs/en/search?q=1"
    )


def apple(spark, sf):
    orders = table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        "o_orderdate",
    )
    k = "o_orderkey"
    number = F.col(k).cast("string")
    function = F.concat(F.lit("<jobFunction>"), every(k, 43, F.lit("R&D "), F.lit("")), "o_orderstatus",
                        F.col("term_no"), F.lit("</jobFunction>"))
    text = F.concat(
        F.lit("<requisition><jobId>"), number, F.lit("</jobId>"),
        every(k, 31, F.lit(""), function), F.lit("</requisition>"),
    )
    records = two_terms(orders, k).select("term_no", F.col(k).alias("number"), text.alias("text"))
    lists = list_pages(
        records, "apple", "<result><count>100</count>", "", "</result>",
        "https://jobs.apple.com/us/search/search-result",
    )
    # Every fifth page ends early, before the end tags of its last record.
    cut = F.regexp_replace("body", "</requisition></result>$", "")
    lists = lists.withColumn("body", F.when(F.col("page") % 5 == 2, cut).otherwise(F.col("body")))
    fields = json_object(
        keyQualifications=F.concat(F.lit(" one \n\n two "), "o_custkey"),
        additionalRequirements=every(k, 2, F.col("o_orderstatus")),
        educationDetails=every(k, 3, F.lit(NULL), F.lit("none")),
        other=F.lit("left out"),
    )
    info = json_object(
        formId=every(k, 37, F.lit(None), F.col(k)),
        postingTitle=F.when(F.col(k) % 17 != 0, every(k, 19, F.lit(NULL), F.col("o_orderpriority"))),
        locationName=F.concat(F.lit("Place "), "o_custkey"),
        stateAbbr=F.when(F.col(k) % 2 == 0, F.lit("NY")),
        reqOpenDt=every(k, 23, F.lit("soon"), F.date_format("o_orderdate", "dd-MMM-yyyy")),
    )
    # No body is NULL; without a word on it, the plan's filter on bodies would make each before it is dealt out and again.
    made = [F.coalesce(c, F.lit("")) for c in (info, fields)]
    body = F.concat(
        F.lit('{"requisitionInfo":'), made[0], F.lit(',"jobComments":" c","reqTextFields":'), made[1],
        F.lit("}"),
    )
    arrived = spread(orders.filter(F.col(k) % 41 != 0))
    details = raw(
        arrived, "apple", "detail", body, list_id=number,
        url=F.lit("https://jobs.apple.com/us/requisition/detail.json"),
    )
    return lists.unionByName(details)


def facebook(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    k = "doc_id"
    number = F.col(k).cast("string")
    place = F.when(F.col(k) % 5 == 0, F.lit("Paris, France")).otherwise(F.lit("Menlo Park, CA"))
    path = F.when(
        (F.col(k) % 13 == 0) & (F.col("term_no") == 1), F.lit("/careers/other/")
    ).otherwise(F.concat(F.lit("/careers/jobs/"), number, F.lit("/")))
    card = F.concat(
        F.lit('<div class="_3k6i"><a class="x _5144" href="'), path, F.lit('">Job</a>'),
        F.lit('<div class="_3k6n y"><span>'), place, F.lit("</span></div></div>"),
    )
    ids = docs.select(k)
    records = two_terms(ids, k).select("term_no", F.col(k).alias("number"), card.alias("text"))
    lists = list_pages(
        records, "facebook", "<html><body>", "<br>", "</body></html>",
        "https://www.facebook.com/careers/search/?q=x",
    )
    places = F.when(F.col(k) % 7 == 0, F.lit("A, NY")).otherwise(F.lit("(A, NY - B, CA)"))
    link = F.when(F.col(k) % 11 == 0, F.lit("/careers/other")).otherwise(
        F.concat(F.lit("/careers/resume?x=1&amp;req=r"), number, F.lit("&amp;y=2"))
    )
    lines = F.transform(
        F.split(markup(F.col("text")), "\n"),
        lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>")),
    )
    body = F.concat(
        F.lit('<!DOCTYPE html><html><body><div class="_35i2 z"> '), "source",
        F.lit('</div><div class="_4ycv"><div><h1 class="_4ycw"> Title <b>'), number,
        F.lit('</b> </h1><div class="w _4ycx">'), places,
        F.lit('</div><a id="u_0_d" href="'), link, F.lit('">Apply</a></div><div>Intro '), "lang",
        F.lit("</div>"),
        every(k, 3, F.lit(""), F.concat(F.lit('<div class="d">'), markup(F.col("text")),
                                        F.lit("</div>"))),
        F.lit('<div class="_wrz"><h4> Lines </h4><ul>'), F.array_join(lines, ""),
        F.lit("</ul></div></div></body></html>"),
    )
    details = raw(
        spread(docs), "facebook", "detail", body, list_id=number,
        url=F.concat(F.lit("https://www.facebook.com/careers/jobs/"), number, F.lit("/")),
    )
    return lists.unionByName(details)


def dice(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    k = "doc_id"
    number = F.col(k).cast("string")
    day = F.date_add(F.lit("2017-01-01").cast("date"), (F.col(k) % 1000).cast("int"))
    text = json_object(
        detailUrl=every(k, 29, F.lit("http://www.dice.com/job/"), F.concat(
            F.lit("http://www.dice.com/job/result/"), number, F.lit("?src=19"))),
        jobTitle=F.concat(F.lit("Job "), number, F.lit(" under "), F.col("term_no")),
        company=every(k, 31, F.lit(NULL), F.concat(F.lit(" "), "source")),
        location=F.col("lang"),
        date=F.when(F.col(k) % 17 != 0, every(k, 23, F.lit("soon"), F.date_format(day, "yyyy-M-d"))),
    )
    rows = two_terms(docs.select(k, "lang", "source"), k)
    lists = list_pages(
        rows.select("term_no", F.col(k).alias("number"), text.alias("text")),
        "dice", '{"resultItemList":[', ",", "]}", "http://service.dice.com/api",
    )
    body = F.concat(
        F.lit('<html><body><div>Menu</div><div id="jobdescSec">'),
        F.replace(markup(F.col("text")), F.lit("\n"), F.lit("<br>")),
        F.lit("</div><div>Footer</div></body></html>"),
    )
    details = raw(
        spread(docs.filter(F.col(k) % 19 != 0)), "dice", "detail", body, list_id=number,
        url=F.concat(F.lit("https://www.dice.com/jobs/detail/"), number),
    )
    return lists.unionByName(details)


def indeed(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    k = "doc_id"
    number = F.col(k).cast("string")
    day = F.date_add(F.lit("2017-01-01").cast("date"), (F.col(k) % 1000).cast("int"))
    written = F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 17:41:20 GMT"))
    text = json_object(
        jobkey=number,
        url=every(k, 29, F.lit(None), F.concat(F.lit("http://www.indeed.com/viewjob?jk="), number)),
        jobtitle=F.concat(F.lit("Job "), number, F.lit(" under "), F.col("term_no")),
        company=every(k, 31, F.lit(NULL), F.concat(F.lit(" "), "source")),
        formattedLocationFull=every(k, 4, F.lit("Full place")),
        formattedLocation=every(k, 2, F.lit(" Short place ")),
        city=every(k, 3, F.col("lang")),
        date=F.when(F.col(k) % 17 != 0, every(k, 23, F.lit("today"), written)),
    )
    rows = two_terms(docs.select(k, "lang", "source"), k)
    lists = list_pages(
        rows.select("term_no", F.col(k).alias("number"), text.alias("text")),
        "indeed", '{"results":[', ",", "]}", "http://api.indeed.com/ads/apisearch",
    )
    cell = F.concat(
        F.lit('<a class="sl view_job_link" href="/rc/clk?jk='), number, F.lit('&amp;fr=1">View</a>'),
        F.lit('<span id="job_summary">'),
        F.replace(markup(F.col("text")), F.lit("\n"), F.lit("<br>")),
        F.lit("</span>"),
    )
    body = F.concat(
        F.lit('<html><body><table id="job-content">'), every(k, 5, F.lit("<tbody>"), F.lit("")),
        F.lit("<tr><td><table><tr><td>"), cell,
        F.lit("</td><td>Side</td></tr></table></td></tr></table></body></html>"),
    )
    details = raw(
        spread(docs.filter(F.col(k) % 19 != 0)), "indeed", "detail", body, list_id=number,
        url=F.concat(F.lit("http://www.indeed.com/viewjob?jk="), number),
    )
    return lists.unionByName(details)
