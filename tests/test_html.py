import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.functions import html as H
from vacantia.operators.html_nodes import html_nodes
from vacantia.operators.listings import explode_listings
from vacantia.session import SETTINGS
from workload.registry import _bounded


def tree(page):
    """Nodes as (tag or text, parent)."""
    return [(n[8] if n[4] == H.TEXT else n[4], n[1]) for n in H.parse(page)]


def test_nesting_and_numbers():
    nodes = H.parse("<div><p>a</p><p>b<b>c</b></p></div>d")
    assert [(n[0], n[1], n[2], n[3], n[4]) for n in nodes] == [
        (0, -1, 6, 1, "div"), (1, 0, 2, 1, "p"), (2, 1, 2, 1, "#text"), (3, 0, 6, 2, "p"),
        (4, 3, 4, 1, "#text"), (5, 3, 6, 1, "b"), (6, 5, 6, 1, "#text"), (7, -1, 7, 1, "#text"),
    ]


def test_open_elements_are_ended_by_the_next():
    assert tree("<ul><li>a<li>b</ul>c") == [
        ("ul", -1), ("li", 0), ("a", 1), ("li", 0), ("b", 3), ("c", -1)]
    assert tree("<p>a<p>b<div>c</div>") == [
        ("p", -1), ("a", 0), ("p", -1), ("b", 2), ("div", -1), ("c", 4)]
    assert tree("<table><tr><td>a<td>b<tr><td>c</table>") == [
        ("table", -1), ("tr", 0), ("td", 1), ("a", 2), ("td", 1), ("b", 4), ("tr", 0), ("td", 6),
        ("c", 7)]


def test_void_and_self_closed_elements_hold_nothing():
    assert tree("a<br>b<img src=x>c<span/>d<a href=/x/>e</a>") == [
        ("a", -1), ("br", -1), ("b", -1), ("img", -1), ("c", -1), ("span", -1), ("d", -1),
        ("a", -1), ("e", 7)]


def test_text_is_decoded_and_joined_over_stray_end_tags():
    assert tree("a &amp; b&nbsp;&lt;i&gt;</b>c<!-- x -->d") == [
        ("a & b\xa0<i>c", -1), ("d", -1)]


@pytest.mark.parametrize(
    "text,want",
    [("&copy;&eacute;&apos;", "\xa9\xe9'"), ("&ampx", "&ampx"), ("?a=1&copy=2", "?a=1&copy=2"),
     ("&#65;&#x42;&#67", "ABC"), ("&nosuch;&;&", "&nosuch;&;&"), ("&amp;lt;", "&lt;"),
     ("a&#0;&#xD800;&#99999999;b", "ab"), ("&#" + "9" * 5000 + ";&#0000065;", "A")],
)
def test_entities(text, want):
    assert H.decoded(text) == want


def test_weak_end_tag_does_not_close_a_strong_element():
    assert tree("<b><div>a</b>b</div>c") == [("b", -1), ("div", 0), ("ab", 1), ("c", 0)]


def test_script_text_is_not_markup():
    assert tree('<script>var t="</p><b>";</script>x') == [
        ("script", -1), ('var t="</p><b>";', 0), ("x", -1)]
    assert tree("<style>a<b") == [("style", -1), ("a<b", 0)]


def test_attributes():
    node = H.parse("<A CLASS='x y' Id=q href=\"/a?b=1&amp;c=2\" id=z data-x='>'>")[0]
    assert node[4:8] == ["a", "q", "x y", "/a?b=1&c=2"]


@pytest.mark.parametrize("page", ["<", "a < b", "<a href='x", "<!-- never ended", "</", "<p", "&", "<>"])
def test_broken_markup_is_read_anyhow(page):
    assert isinstance(H.parse(page), list)


PAGE = (
    '<div class="a x"><p>1<br>2</p></div><div class="ax"><div class="a"><a>0</a>'
    '<a href="/h" id="i">3</a><a href="/g">4</a></div></div><div>5</div>'
)


@pytest.fixture
def page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "list_id int, body string")
    return df.withColumn("nodes", H.nodes(F.col("body")))


def pick(page, made):
    return page.filter("list_id = 1").select(made.alias("x")).first().x


def test_selectors(page):
    nodes = F.col("nodes")
    exact = H.select(nodes, H.tagged("div", H.has_class("a")))
    part = H.select(nodes, H.tagged("div", H.class_contains("a")))
    other = H.select(nodes, H.tagged("div", H.class_other_than("a")))
    assert pick(page, F.size(exact)) == 1
    assert pick(page, F.size(part)) == 3
    assert pick(page, F.size(other)) == 2
    assert pick(page, H.text_of(nodes, exact)) == "034"
    assert pick(page, H.text_of(nodes, part, "\n")) == "1\n2\n0\n3\n4"
    assert pick(page, H.first_href(H.inside(nodes, exact, H.tagged("a")))) == "/h"
    assert pick(page, H.first_href(H.inside(nodes, part, H.tagged("a", H.has_id("i"))))) == "/h"
    assert pick(page, H.text_of(nodes, H.children(nodes, exact, "a", 3))) == "4"
    assert pick(page, F.size(H.children(nodes, exact, "a"))) == 3
    assert pick(page, H.tag_texts(nodes, "div")) == ["12", "034", "034", "5"]


def test_pages_without_markup(page):
    made = page.select("list_id", F.size("nodes").alias("n"), H.visible_text(F.col("nodes")).alias("t"))
    rows = {r.list_id: (r.n, r.t) for r in made.collect()}
    assert rows[2] == rows[3] == (0, "")


def test_node_table(spark):
    df = spark.createDataFrame([("k", PAGE)], "list_id string, body string")
    rows = html_nodes(df).orderBy("node_no").collect()
    assert len(rows) == len(H.parse(PAGE))
    assert rows[0].tag == "div" and rows[0]["class"] == "a x" and rows[0].parent_no == -1


def test_pages_are_parsed_once(page):
    nodes = F.col("nodes")
    two = page.select(
        H.text_of(nodes, H.select(nodes, H.tagged("div"))).alias("t"),
        H.first_href(H.select(nodes, H.tagged("a"))).alias("h"),
    )
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<a " * n, lambda n: "<b>" * n + "</i>" * n, lambda n: "<i><td>" + "<b>" * n + "</i>" * n,
        lambda n: '<a ">" ' * n, lambda n: "<" * n, lambda n: '<a "' * n + ">", lambda n: "a&b<" * n,
        lambda n: "<p>" * n, lambda n: "<script>" * n,
    ],
)
def test_parsing_takes_linear_time(page):
    def seconds(n):
        began = time.perf_counter()
        H.parse(page(n))
        return time.perf_counter() - began

    small = min(seconds(10_000) for _ in range(3))
    assert seconds(40_000) < 12 * small + 0.2


def test_a_tag_whose_quotes_do_not_close_ends_at_the_next_bracket():
    tags = [(n[4], n[8]) for n in H.parse("<p class=\"x>one</p><p>two</p>")]
    assert tags == [("p", None), ("#text", "one"), ("p", None), ("#text", "two")]


def test_cards_take_linear_time(spark):
    from payloads import landed, page

    from vacantia.plans.facebook import list_records

    def seconds(n):
        cards = "".join(
            f'<div class="_3k6i"><a class="_5144" href="/careers/jobs/{i}/">J</a><div class="_3k6n">A, CA</div></div>'
            for i in range(n)
        )
        raw = landed(spark, [page("facebook", f"<html><body>{cards}</body></html>")])
        began = time.perf_counter()
        assert list_records(raw).count() == n
        return time.perf_counter() - began

    small = min(seconds(2_000) for _ in range(3))
    assert seconds(8_000) < 10 * small + 2


def test_a_batch_goes_on_in_bounded_pieces():
    page = "<p>a</p>" * 1_000
    pieces = list(H._parse_batch(pa.array([page, None, *[page] * 40, "", page])))
    assert [len(p) for p in pieces[:2]] == [6, 5] and sum(len(p) for p in pieces) == 44
    assert max(len(p.flatten()) for p in pieces) < H.CHUNK + 2_000
    assert pieces[0][1].as_py() == [] and len(pieces[-1][-1].as_py()) == 2_000
    long = "x" * (H.CHUNK_CHARS // 2)
    assert [len(p) for p in H._parse_batch(pa.array([long] * 5))] == [2, 2, 1]
    assert not list(H._parse_batch(pa.array([], pa.string())))


def test_pieces_meet_their_rows_in_spark(spark, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 7)
    rows = [(i, None if i % 5 == 0 else f"<b>{i}</b>" * (i % 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, body string").coalesce(1)
    made = df.select("k", "body", H.nodes(F.col("body")).alias("nodes"))
    texts = made.select("k", "body", F.size("nodes").alias("n"), H.visible_text(F.col("nodes")).alias("t"))
    assert [tuple(r) for r in texts.orderBy("k").collect()] == [
        (k, b, 0 if not b else 2 * (k % 4), str(k) * (k % 4) if b else "") for k, b in rows]


def test_queries_bound_batches_in_any_session(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        _bounded(lambda session: session)(spark)
        assert spark.conf.get(key) == SETTINGS[key] == "4m"
    finally:
        spark.conf.set(key, before)


def test_pages_are_parsed_once_whatever_is_made_of_them(spark):
    pages = spark.createDataFrame([(1, "<li>a</li><h1>b</h1>"), (2, "c"), (3, None)], "list_id int, body string")
    page = pages.select("list_id", H.nodes(F.col("body")).alias("nodes"))
    lists = F.array(*(
        F.struct(F.lit(tag).alias("type"), H.tag_texts(F.col("nodes"), tag).alias("elements")) for tag in ("li", "h1")))
    long = explode_listings(page.withColumn("listings", lists), ("list_id",))
    assert sorted((r.list_id, r.type, r.element) for r in long.collect()) == [(1, "h1", "b"), (1, "li", "a")]
    for made in (long, html_nodes(pages)):
        assert made._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
