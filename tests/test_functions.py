import datetime

import pytest
from pyspark.sql import functions as F

from vacantia.functions import dates as D
from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.functions import urls as U


def value(spark, fn, *args):
    row = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
    return row.select(fn(*(F.col(c) for c in row.columns))).first()[0]


@pytest.mark.parametrize("text", ["\t a b\n", " a b\xa0", "　a b ", "\x1ca b\x85", "a b"])
def test_strip(spark, text):
    assert value(spark, X.strip, text) == text.strip() == "a b"


def test_split_lines(spark):
    assert value(spark, X.split_lines, " a\n\n \tb \n") == ["a", "b"]
    assert value(spark, X.split_lines, "") == []


def test_split_bullets(spark):
    assert value(spark, X.split_bullets, "• a<br/> • b<br/>\n•c") == ["a", "b", "c"]
    assert value(spark, X.split_bullets, "• a<br/> • b<br/>• ") == ["a", "b"]
    literal = lambda c: X.split_bullets(c, literal=True)
    assert value(spark, literal, "• a<br/> • b") == ["a<br/>  b"]
    assert value(spark, literal, "a<br/> u2022b") == ["a", "b"]


def test_places(spark):
    assert value(spark, X.joined_places, "(A, CA - B, NY)") == "A, CA|B, NY"
    assert value(spark, X.joined_places, "(A, CA)") == "A, CA"
    assert value(spark, X.joined_places, "A, CA") is None
    assert value(spark, X.joined_places, "()") is None
    assert value(spark, X.places, "(A - B)") == ["A", "B"]


def test_place_with_state(spark):
    assert value(spark, X.place_with_state, "A", "NY") == "A, NY"
    assert value(spark, X.place_with_state, "A", "") == "A"


@pytest.mark.parametrize(
    "text,hit",
    [("Menlo Park, CA", True), ("Toronto, CAN", True), ("Paris, France", False), ("x,CA", False),
     ("A, ca", False), ("(A, NY) now", True)],
)
def test_names_a_state(spark, text, hit):
    assert value(spark, X.names_a_state, text) is hit


@pytest.mark.parametrize(
    "fn,text,day",
    [
        (D.long_month_date, "February 9, 2017", (2017, 2, 9)),
        (D.long_month_date, "February  09,  2017", (2017, 2, 9)),
        (D.long_month_date, "february 9, 2017", (2017, 2, 9)),
        (D.long_month_date, "Feb 9, 2017", None),
        (D.long_month_date, "February 30, 2017", None),
        (D.long_month_date, "February 9, 17", None),
        (D.long_month_date, "", None),
        (D.day_month_date, "09-Feb-2017", (2017, 2, 9)),
        (D.day_month_date, "9-FEB-2017", (2017, 2, 9)),
        (D.day_month_date, "31-feb-2017", None),
        (D.day_month_date, "09-Feb-17", None),
        (D.iso_date, "2017-02-09", (2017, 2, 9)),
        (D.iso_date, "2017-2-9", (2017, 2, 9)),
        (D.iso_date, "2017-02-09T00:00", None),
        (D.rfc822_date, "Wed, 25 Jan 2017 17:41:20 GMT", (2017, 1, 25)),
        (D.rfc822_date, "Wed, 5  Jan 2017, 17:41", (2017, 1, 5)),
        (D.rfc822_date, "Wed, 25 Jan 17 17:41:20 GMT", None),
        (D.rfc822_date, "25 Jan 2017", None),
        (D.site_date, "2017-02-09", (2017, 2, 9)),
        (D.site_date, "2017/2/9", (2017, 2, 9)),
        (D.site_date, "2017-02-09 10:11:12", (2017, 2, 9)),
        (D.site_date, "NA", None),
        (D.site_date, None, None),
    ],
)
def test_dates(spark, fn, text, day):
    assert value(spark, fn, text) == (day and datetime.date(*day))


def test_rfc822_day_misses_and_keeps(spark):
    assert value(spark, D.rfc822_day, "Wed, 25 Jan 17 17:41:20 GMT") == "25 Jan 17"
    assert value(spark, D.rfc822_day, "30+ days ago") is None


@pytest.mark.parametrize("days,week", [(0, 0), (6, 0), (7, 1), (34, 4), (35, 5), (-3, 0), (-7, -1)])
def test_week_age(spark, days, week):
    newest = datetime.date(2017, 3, 1)
    made = D.week_age(F.lit(newest), F.lit(newest - datetime.timedelta(days)))
    assert spark.range(1).select(made).first()[0] == week


def test_ids_from_urls(spark):
    assert value(spark, U.path_id, "/careers/jobs/a0I12/?x") == "a0I12"
    assert value(spark, U.path_id, "/careers/jobs/a0I12") is None
    assert value(spark, U.path_id, None) is None
    assert value(spark, U.request_id, "/careers/resume?req=a1&x=2") == "a1"
    assert value(spark, U.request_id, "/careers/resume?x=2&req=a1") == "a1"
    assert value(spark, U.request_id, "/careers/resume?xreq=a1") is None
    assert value(spark, U.request_id, "https://h/careers/resume?req=a1") is None
    assert value(spark, U.result_id, "http://h/job/result/a/b?src=1?src=2") == "a/b?src=1"
    assert value(spark, U.result_id, "http://h/job/result/a") is None


def test_urls(spark):
    assert value(spark, U.detail_url, "http://www.dice.com/job/result/a?src=19") == (
        "https://www.dice.com/jobs/detail/a?src=19"
    )
    assert value(spark, U.posting_url, "7") == "https://jobs.apple.com/us/search#&ss=7"


@pytest.mark.parametrize(
    "ref,want",
    [
        ("/en/jobs/1", "https://h.example/en/jobs/1"),
        ("https://o.example/x", "https://o.example/x"),
        ("mailto:a@b", "mailto:a@b"),
        ("//o.example/x", "https://o.example/x"),
        ("y?z", "https://h.example/a/y?z"),
        ("?z=1", "https://h.example/a/b?z=1"),
        ("#top", "https://h.example/a/b?q=c/d#top"),
        ("", "https://h.example/a/b?q=c/d"),
        (None, "https://h.example/a/b?q=c/d"),
    ],
)
def test_resolve(spark, ref, want):
    assert value(spark, U.resolve, "https://h.example/a/b?q=c/d", ref) == want


@pytest.mark.parametrize(
    "ref,want",
    [
        ("../c", "https://h.example/a/c"),
        ("./d", "https://h.example/a/b/d"),
        ("/a/../b", "https://h.example/b"),
        ("..", "https://h.example/a/"),
        (".", "https://h.example/a/b/"),
        ("../../../../x", "https://h.example/x"),
        ("../x/./y/../z?p=/../q#/./r", "https://h.example/a/x/z?p=/../q#/./r"),
        ("%2e%2E/x", "https://h.example/a/x"),
        ("..x/y.", "https://h.example/a/b/..x/y."),
        ("/x//../y", "https://h.example/x/y"),
        ("https://o.example/a/../b", "https://o.example/a/../b"),
    ],
)
def test_resolve_follows_dot_segments(spark, ref, want):
    assert value(spark, U.resolve, "https://h.example/a/b/c?q=1", ref) == want


def test_resolve_against_bare_host(spark):
    assert value(spark, U.resolve, "https://h.example", "x") == "https://h.example/x"


def test_json_members(spark):
    text = '{"a": 1, "b": null, "c": "x", "d-e": {"f": ["y"]}}'
    get = lambda *keys: lambda c: J.json_field(c, *keys)
    assert value(spark, get("a"), text) == "1"
    assert value(spark, get("b"), text) is None
    assert value(spark, get("d-e", "f", 0), text) == "y"
    assert value(spark, get("a"), "{bad") is None
    default = lambda c: J.json_default(c, "z")
    assert value(spark, default, text) == ""


@pytest.mark.parametrize(
    "text,required,want",
    [
        ('{"k": " v"}', False, (" v", None)),
        ("{}", False, ("", None)),
        ("{}", True, ("", "k is missing")),
        ('{"k": null}', False, ("", "k is not text")),
        ('{"k": 5}', False, ("5", "k is not text")),
        ('{"k": ["v"]}', False, ('["v"]', "k is not text")),
    ],
)
def test_text_field(spark, text, required, want):
    def both(c):
        field = J.text_field(F.try_parse_json(c), "k", required=required)
        return F.struct(field.value, field.problem)

    assert tuple(value(spark, both, text)) == want


@pytest.mark.parametrize(
    "text,want", [("true", "True"), ("null", ""), ('"a"', "a"), ("12", "12"), ("1.5", "1.5")]
)
def test_printed(spark, text, want):
    assert value(spark, lambda c: J.printed(F.try_parse_json(c)), text) == want
