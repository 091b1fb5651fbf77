"""Sources that deliver HTML lists or details."""

import datetime

from payloads import LATER, detail, landed, page, rows_by

import vacantia as v

DAY = datetime.date(2017, 2, 9)


def card(job_id, place="Menlo Park, CA", href=None):
    href = href or f"/careers/jobs/{job_id}/?x"
    return (f'<div class="_3k6i"><a class="_5144 z" href="{href}">J</a><div class="a _3k6n">'
            f"<b>{place}</b></div></div>")


def post(job_id, places="(Menlo Park, CA)", href=None, middle="<div>intro <br>more</div>",
         third='<div class="t">Do <b>things</b><br>well</div>', sections=None):
    href = href or f"/careers/resume?req={job_id}"
    sections = sections if sections is not None else (
        '<div class="_wrz"><h4> Needs </h4><ul><li> a</li><li></li><li>b <i>c</i></li></ul></div>')
    return (f'<html><body><div class="x _35i2">Topic</div><div class="_4ycv"><div>'
            f'<h1 class="_4ycw">Title &amp; more</h1><div class="_4ycx">{places}</div>'
            f'<a id="u_0_d" href="{href}">Apply</a></div>{middle}{third}{sections}</div></body></html>')


def facebook(spark, cards, posts, **options):
    rows = [page("facebook", f"<html><body>{''.join(cards)}</body></html>")]
    rows += [detail("facebook", k, body, url=f"https://h.example/careers/jobs/{k}/")
             for k, body in posts.items()]
    accepted, rejected = v.normalise_facebook(landed(spark, rows), **options)
    return rows_by(accepted, "list_id"), {r.list_id: r.error_reason for r in rejected.collect()}


def test_facebook_posting(spark):
    rows, rejected = facebook(spark, [card("k1")], {"k1": post("r1")})
    assert rejected == {}
    assert rows["k1"].asDict(recursive=True) == {
        "source": "facebook", "list_id": "k1", "job_id": "r1", "title": "Title & more",
        "department": "Topic", "location": "Menlo Park, CA", "date_posted": None,
        "time_scraped": LATER, "url": "https://h.example/careers/jobs/k1/",
        "company_intro": "intro more", "role_description": "Do thingswell",
        "listings": [{"type": "Needs", "elements": ["a", "", "b c"]}], "date_posted_raw": None,
    }


def test_facebook_places_and_sections(spark):
    rows, rejected = facebook(
        spark, [card(f"k{i}") for i in range(7)],
        {
            "k0": post("r0", places="(Menlo Park, CA - New York, NY)"),
            "k1": post("r1", places="Menlo Park, CA"),
            "k2": post("r2", href="/careers/other"),
            "k3": post("r3", third=""),
            "k4": post("r4", third="<div>no class</div>", sections=""),
            "k5": post("r5", sections='<div class="_wrz"><h4>A</h4></div><div class="_wrz"><ul>'
                                      "<li>x</ul></div>"),
        },
    )
    assert rejected == {"k1": "location has no brackets", "k2": "apply link has no id"}
    assert set(rows) == {"k0", "k3", "k4", "k5"}
    assert rows["k0"].location == "Menlo Park, CA|New York, NY"
    # The third block is a section, or has no class: no description either way.
    assert rows["k3"].role_description == "" and rows["k3"].listings[0].type == "Needs"
    assert rows["k4"].role_description == "" and rows["k4"].listings == []
    assert [(s.type, s.elements) for s in rows["k5"].listings] == [("A", []), ("", ["x"])]


def test_facebook_place_filter_claims_no_id(spark):
    rows = [
        page("facebook", card("k1", "Paris, France") + card("k2", "Toronto, CAN")),
        page("facebook", card("k1", "Menlo Park, CA"), term_no=1),
        page("facebook", card("x", href="/careers/other/") + '<div class="_3k6i">no link</div>'
             + '<div class="_3k6i y">other class</div>', term_no=2),
        detail("facebook", "k1", post("r1")), detail("facebook", "k2", post("r2")),
    ]
    accepted, rejected = v.normalise_facebook(landed(spark, rows))
    assert set(rows_by(accepted, "list_id")) == {"k1", "k2"}
    assert [r.error_reason for r in rejected.collect()] == ["link has no id"] * 2


def result(job_id, drop=(), **changes):
    made = {"detailUrl": f"http://www.dice.com/job/result/{job_id}?src=19", "jobTitle": " T",
            "company": " C ", "location": "NY", "date": "2017-02-09"} | changes
    return {k: x for k, x in made.items() if k not in drop}


BODY = '<html><div>no</div><div id="jobdescSec"> a<br>b &amp; <p>c</p><!-- n --></div>no</html>'


def test_dice(spark):
    items = [
        result("a"), result("b", company=None), result("c", date="x"), result("d", ["detailUrl"]),
        result("e", detailUrl="http://h/none"), result("f"), result("a", jobTitle="again"),
        result("g", ["jobTitle", "company", "location", "date"]), result("h", detailUrl=None),
    ]
    rows = [page("dice", {"resultItemList": items})]
    rows += [detail("dice", k, BODY, url=f"https://d.example/{k}") for k in "abcdeg"]
    accepted, rejected = v.normalise_dice(landed(spark, rows))
    got = rows_by(accepted, "job_id")
    assert set(got) == {"a", "g"}
    assert got["a"].asDict(recursive=True) == {
        "source": "dice", "list_id": "a", "job_id": "a", "title": "T", "company": "C",
        "department": None, "location": "NY", "date_posted": DAY, "time_scraped": LATER,
        "url": "https://d.example/a", "company_intro": None, "role_description": "a\nb & \nc",
        "listings": [], "original_url": None, "date_posted_raw": None,
    }
    assert (got["g"].title, got["g"].company, got["g"].date_posted) == ("", "", None)
    assert sorted(r.error_reason for r in rejected.collect()) == sorted([
        "company is not text", "date is not a date", "detailUrl is missing", "detailUrl has no id",
        "detailUrl is not text"])


def test_dice_detail_without_url_gets_the_rewritten_one(spark):
    rows = [page("dice", {"resultItemList": [result("a")]}), detail("dice", "a", BODY, url=None)]
    accepted, _ = v.normalise_dice(landed(spark, rows))
    assert accepted.first().url == "https://www.dice.com/jobs/detail/a?src=19"


def hit(job_id, drop=(), **changes):
    made = {"jobkey": job_id, "url": f"http://i.example/v?jk={job_id}", "jobtitle": " T ",
            "company": " C ", "formattedLocationFull": "Full ", "formattedLocation": "Short",
            "city": "City", "date": "Thu, 09 Feb 2017 17:41:20 GMT"} | changes
    return {k: x for k, x in made.items() if k not in drop}


def view(cell, wrap="{}"):
    inner = f"<table><tr><td>{cell}</td><td>side</td></tr></table>"
    return f'<table id="job-content">{wrap.format(f"<tr><td>{inner}</td></tr>")}</table>'


CELL = '<a class="x view_job_link" href="/rc?a=1&amp;b">V</a><span id="job_summary">a<br> b</span>'


def indeed(spark, items, bodies):
    rows = [page("indeed", {"results": items})]
    rows += [detail("indeed", k, body, url=f"http://i.example/v?jk={k}") for k, body in bodies.items()]
    accepted, rejected = v.normalise_indeed(landed(spark, rows))
    return rows_by(accepted, "job_id"), {r.list_id: r.error_reason for r in rejected.collect()}


def test_indeed_posting(spark):
    rows, rejected = indeed(spark, [hit("a")], {"a": view(CELL)})
    assert rejected == {}
    assert rows["a"].asDict(recursive=True) == {
        "source": "indeed", "list_id": "a", "job_id": "a", "title": "T", "company": " C ",
        "department": None, "location": "Full", "date_posted": DAY, "time_scraped": LATER,
        "url": "http://i.example/v?jk=a", "company_intro": None, "role_description": "a\n b",
        "listings": [], "original_url": "http://i.example/rc?a=1&b", "date_posted_raw": None,
    }


def test_indeed_places_dates_and_bad_records(spark):
    full = "formattedLocationFull"
    rows, rejected = indeed(
        spark,
        [
            hit("a", [full]), hit("b", [full, "formattedLocation"]),
            hit("c", [full, "formattedLocation", "city"]), hit("d", formattedLocationFull=None),
            hit("e", date="30+ days ago"), hit("f", date="Thu, 09 Feb 17 17:41"), hit("g", date=""),
            hit("h", ["url"]), hit("i", company=None), hit("j", ["jobkey"]), hit("k", date=None),
            hit("h", jobtitle="later copy"), hit("l"),
        ],
        {k: view(CELL) for k in "abcdefghijk"},
    )
    assert {k: r.location for k, r in rows.items()} == {
        "a": "Short", "b": "City", "c": "", "e": "Full", "g": "Full", "i": "Full"}
    assert (rows["e"].date_posted, rows["e"].date_posted_raw) == (None, "30+ days ago")
    assert (rows["g"].date_posted, rows["g"].date_posted_raw) == (None, None)
    assert rows["i"].company == ""
    assert rejected == {
        "d": "formattedLocationFull is not text", "f": "date is not a date", "h": "url is missing",
        None: "jobkey is missing", "k": "date is not text"}


def test_indeed_path(spark):
    rows, _ = indeed(
        spark, [hit(k) for k in "abcd"],
        {
            "a": view(CELL, "<tbody>{}</tbody>"),
            "b": view(f"<div>{CELL}</div>"),
            "c": "<span id='job_summary'>x</span>",
            "d": view('<a class="view_job_link">no href</a><span id="job_summary">s</span>'),
        },
    )
    got = {k: (r.role_description, r.original_url) for k, r in rows.items()}
    assert got == {
        "a": ("", None), "b": ("", "http://i.example/rc?a=1&b"), "c": ("", None), "d": ("s", None)}
