"""Sources that deliver JSON or XML lists."""

import datetime

from payloads import AT, LATER, detail, landed, page, rows_by

import vacantia as v
from vacantia.plans import apple
from vacantia.plans.companies import typed_companies
from vacantia.schemas import COMPANY_COLUMNS

DAY = datetime.date(2017, 2, 9)

JOB = {
    "id": "1", "title": " T ", "country_code": "US", "location": "US, NY ",
    "posted_date": "February  9, 2017", "job_category": "c", "description": " d\n",
    "job_path": "/en/jobs/1", "basic_qualifications": "• a<br/> • b<br/>•",
}


def job(drop=(), **changes):
    return {k: x for k, x in (JOB | changes).items() if k not in drop}


def amazon(spark, *jobs, **options):
    raw = landed(spark, [page("amazon", {"hits": len(jobs), "jobs": list(jobs)})])
    accepted, rejected = v.normalise_amazon(raw, **options)
    return rows_by(accepted, "job_id"), rejected.collect()


def reasons(rejected):
    return sorted((r.list_id, r.error_reason) for r in rejected)


def test_amazon_posting(spark):
    rows, rejected = amazon(spark, JOB)
    row = rows["1"].asDict(recursive=True)
    assert rejected == []
    assert row == {
        "source": "amazon", "list_id": "1", "job_id": "1", "title": "T", "department": "c",
        "location": "US, NY", "date_posted": DAY, "time_scraped": AT,
        "url": "https://host.example/en/jobs/1", "company_intro": None, "role_description": "d",
        "listings": [{"type": "Basic Qualifications", "elements": ["a", "b"]}],
        "date_posted_raw": None,
    }


def test_amazon_missing_keys_have_defaults(spark):
    drop = ["location", "posted_date", "job_category", "description", "job_path",
            "basic_qualifications"]
    rows, rejected = amazon(spark, job(drop, id_icims="77"), job(drop, id=2))
    assert rejected == []
    row = rows["1"]
    assert (row.department, row.location, row.date_posted, row.listings) == ("", "", None, [])
    assert row.url == "https://host.example/en/jobs/77"
    assert rows["2"].url == "https://host.example/en/jobs/"


def test_amazon_country(spark):
    rows, rejected = amazon(
        spark,
        job(id="us"),
        job(id="usa", country_code="USA"),
        job(id="ca", country_code="CA"),
        job(id="empty", country_code=""),
        job(id="null", country_code=None),
        job(["country_code"], id="missing"),
        job(["country_code"], id="elsewhere", location="CA, ON"),
        job(["country_code", "location"], id="nowhere"),
        job(["country_code"], id="bad", location=None),
        job(id="number", country_code=5),
    )
    assert set(rows) == {"us", "usa", "null", "missing"}
    assert reasons(rejected) == [
        ("bad", "location is not text"), ("number", "country_code is not text")]


def test_amazon_bad_records(spark):
    rows, rejected = amazon(
        spark,
        job(["title"], id="a"), job(id="b", title=None), job(id="c", posted_date="soon"),
        job(id="d", job_category=None), job(id="e", description=7), job(["id"]),
        job(id="g", id_icims=None), job(id="h", preferred_qualifications=None),
        job(id={"x": 1}), None, "text", job(id="ok", job_path=None), job(id="ok2", posted_date=""),
    )
    assert set(rows) == {"ok", "ok2"}
    assert rows["ok"].url == "https://host.example/list?q=1"
    got = [r.error_reason for r in rejected]
    assert sorted(got) == sorted([
        "title is missing", "title is not text", "posted_date is not a date",
        "job_category is not text", "description is not text", "id is missing",
        "id_icims is not text", "preferred_qualifications is not text", "id is not a single value",
        "record is not an object", "record is not an object",
    ])
    assert all(r.record is not None for r in rejected)


def test_amazon_first_wins_across_terms_even_if_bad(spark):
    raw = landed(spark, [
        page("amazon", {"jobs": [job(title="second"), job(id="2"), job(id="3", location=None,
                                                                      country_code=None)]}, term_no=1),
        page("amazon", {"jobs": [job(title="first"), job(id="2", title=None)]}, term_no=0, page=3),
        page("amazon", {"jobs": [job(id="3", title="later")]}, term_no=2),
    ])
    accepted, rejected = v.normalise_amazon(raw)
    rows = rows_by(accepted, "job_id")
    # A bad first copy hides the good one; a record without a country claims nothing.
    assert {k: r.title for k, r in rows.items()} == {"1": "first", "3": "later"}
    assert reasons(rejected.collect()) == [
        ("2", "title is not text"), ("3", "location is not text")]


def test_amazon_bad_pages(spark):
    raw = landed(spark, [
        page("amazon", "{bad"), page("amazon", [1], page=1), page("amazon", {"jobs": None}, page=2),
        page("amazon", {"hits": "x", "jobs": [JOB]}, page=3), page("amazon", {"hits": 1}, page=4),
        page("amazon", {"jobs": []}, page=5), page("apple", {"jobs": [JOB]}),
    ])
    accepted, rejected = v.normalise_amazon(raw)
    assert accepted.count() == 0
    found = {r.error_reason: r.record for r in rejected.collect()}
    assert set(found) == {"body is not JSON", "body is not an object", "jobs is not a list",
                          "hits is not a number"}
    assert found["body is not JSON"] == "{bad"


def test_amazon_literal_split(spark):
    rows, _ = amazon(spark, job(basic_qualifications="• a<br/> • b<br/> u2022c"), split_bullets=False)
    assert rows["1"].listings[0].elements == ["a<br/>  b", "c"]


INFO = {"formId": 53, "postingTitle": " T", "locationName": "Austin", "stateAbbr": "TX",
        "reqOpenDt": "09-Feb-2017"}
FIELDS = {"keyQualifications": " a\n\n b ", "description": "x", "unknown": "y", "educationDetails": 5,
          "additionalRequirements": ["z"]}


def requisition(job_id, function="<jobFunction> Eng </jobFunction>"):
    return f"<requisition><jobId>{job_id}</jobId>{function}</requisition>"


def apple_list(*parts, **where):
    return page("apple", f"<result><count>9</count>{''.join(parts)}</result>", **where)


def apple_detail(job_id, drop=(), **info):
    made = {k: x for k, x in (INFO | info).items() if k not in drop}
    return detail("apple", job_id, {"requisitionInfo": made, "jobComments": " c ",
                                    "reqTextFields": FIELDS})


def test_apple_values_are_computed_once(spark):
    raw = landed(spark, [apple_list(requisition(11)), apple_detail("11"), apple_detail("12", reqOpenDt="soon")])
    pages = apple.details(raw.repartition(2))
    assert {r.claim: (r.day, r.detail_problem) for r in pages.collect()} == {
        "11": (DAY, None), "12": (None, "reqOpenDt is not a date")}
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        shown = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
        assert shown(pages).count("gettimestamp(") == 1
        # Of each of two fields: no second look at the record's nodes for the end of the element.
        assert shown(apple.list_records(raw.repartition(2)).select("item")).count("= jobid") == 1
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_apple_posting(spark):
    raw = landed(spark, [apple_list(requisition(11)), apple_detail("11")])
    accepted, rejected = v.normalise_apple(raw)
    assert rejected.collect() == []
    row = accepted.first().asDict(recursive=True)
    assert row == {
        "source": "apple", "list_id": "11", "job_id": "53", "title": "T", "department": "Eng",
        "location": "Austin, TX", "date_posted": DAY, "time_scraped": LATER,
        "url": "https://jobs.apple.com/us/search#&ss=53", "company_intro": None,
        "role_description": "c",
        "listings": [{"type": "Description", "elements": ["x"]},
                     {"type": "Qualifications", "elements": ["a", "b"]}],
        "date_posted_raw": None,
    }


def test_apple_bad_records(spark):
    ids = range(1, 12)
    raw = landed(spark, [
        apple_list(*(requisition(i) for i in ids if i != 9), requisition(9, ""),
                   "<requisition><jobFunction>E</jobFunction></requisition>"),
        apple_list(requisition(1), requisition(77), term_no=1),
        apple_detail("1"), apple_detail("2", ["formId"]), apple_detail("3", formId=0),
        apple_detail("4", postingTitle=""), apple_detail("5", postingTitle=None),
        apple_detail("6", reqOpenDt="x"), apple_detail("7", stateAbbr=None),
        apple_detail("8", locationName=None), apple_detail("9"),
        detail("apple", "10", {"requisitionInfo": None}), detail("apple", "11", "{bad"),
        detail("apple", "77", {"requisitionInfo": INFO, "reqTextFields": None}),
    ])
    accepted, rejected = v.normalise_apple(raw)
    assert [r.list_id for r in accepted.collect()] == ["1"]
    got = {r.list_id: r.error_reason for r in rejected.collect()}
    assert got == {
        "2": "title or id is missing", "3": "title or id is missing", "4": "title or id is missing",
        "5": "postingTitle is not text", "6": "reqOpenDt is not a date",
        "7": "stateAbbr is not text", "8": "locationName is not text", "9": "jobfunction is missing",
        "10": "requisitionInfo is not an object", "11": "body is not JSON", None: "jobid is missing",
        "77": "reqTextFields is not an object",
    }


def test_apple_defaults_and_missing_details(spark):
    raw = landed(spark, [
        apple_list(requisition(1), requisition(2)),
        detail("apple", "1", {"requisitionInfo": {"formId": "f1", "postingTitle": "T"}}),
        apple_detail("99"),
    ])
    accepted, rejected = v.normalise_apple(raw)
    rows = accepted.collect()
    assert [(r.job_id, r.location, r.date_posted, r.listings) for r in rows] == [("f1", "", None, [])]
    assert rejected.count() == 0


def test_apple_list_page_without_count(spark):
    raw = landed(spark, [page("apple", f"<result>{requisition(1)}</result>"), apple_detail("1")])
    accepted, rejected = v.normalise_apple(raw)
    assert accepted.count() == 0
    assert [r.error_reason for r in rejected.collect()] == ["count is missing"]


def test_stored_ids_are_left_out(spark):
    raw = landed(spark, [apple_list(requisition(1), requisition(2)), apple_detail("1"),
                         apple_detail("2", formId=54)])
    seen = spark.createDataFrame([("apple", "1"), ("dice", "2"), ("apple", "1")],
                                 "source string, job_id string")
    accepted, rejected = v.normalise_apple(raw, seen)
    assert [r.list_id for r in accepted.collect()] == ["2"]
    assert rejected.count() == 0


COMPANY = {"id": 7, "title": "S", "description": "D", "meta": {"slug": "s", "ranking": "1",
           "newcomer": True, "ceo": None, "global500-y-n": "yes", "revenues": "$1,234.5"},
           "companies": [{"link": "/l", "logo": "x.png"}, {"link": "/other"}]}


def companies(spark, *items):
    return v.flatten_companies(landed(spark, [page("companies", {"list-items": list(items)})]))


def test_company_profile(spark):
    profiles, rejected = companies(spark, COMPANY, COMPANY)
    rows = profiles.collect()
    assert len(rows) == 2 and rejected.count() == 0
    assert profiles.columns == COMPANY_COLUMNS and len(COMPANY_COLUMNS) == 57
    row = rows[0].asDict()
    filled = {k: x for k, x in row.items() if x != ""}
    assert filled == {
        "slug": "s", "fortune_id": "7", "shortname": "S", "ranking": "1", "newcomer": "True",
        "global500-y-n": "yes", "fortune_link": "/l", "logo": "x.png", "description": "D",
        "revenues": "$1,234.5",
    }
    typed = typed_companies(profiles).first()
    assert (typed.ranking, typed.revenues, typed.eps) == (1.0, 1234.5, None)


def test_company_defaults_and_bad_records(spark):
    def but(**changes):
        return {k: x for k, x in (COMPANY | changes).items() if x != "drop"}

    profiles, rejected = companies(
        spark, but(companies="drop", meta="drop"), but(companies=[]), but(companies=None),
        but(meta=None), but(companies=[None]), but(companies=[{}]), None,
    )
    assert sorted((r.fortune_link, r.slug) for r in profiles.collect()) == [("", ""), ("", "s")]
    assert sorted(r.error_reason for r in rejected.collect()) == sorted([
        "companies is empty", "companies is not a list", "meta is not an object",
        "company is not an object", "record is not an object"])


def test_apple_lists_are_read_tolerantly(spark):
    cut = "<result><count>2</count>" + requisition(1) + "<requisition><jobId>2</jobId><jobFunction>R&D"
    raw = landed(spark, [
        page("apple", cut), page("apple", "no markup", page=1), page("apple", "<result><count>x</count></result>", page=2),
        apple_detail("1"), apple_detail("2"),
    ])
    accepted, rejected = v.normalise_apple(raw)
    assert {r.list_id: r.department for r in accepted.collect()} == {"1": "Eng", "2": "R&D"}
    assert sorted(r.error_reason for r in rejected.collect()) == ["body is not XML", "count is not a number"]
