"""HTML pages: text, list items, links, the node table and listings in long form."""

from pyspark.sql import functions as F

from vacantia.functions import html as H
from vacantia.functions import text as X
from vacantia.functions import urls as U
from vacantia.operators.html_nodes import html_nodes
from vacantia.operators.listings import explode_listings
from workload.registry import query, table


def decoded(sql):
    return (
        f"replace(replace(replace(replace({sql}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'),"
        " '&amp;', '&')"
    )


def without_tags(sql):
    return f"regexp_replace({sql}, '<[^>]+>', '', 'g')"


HIDDEN = "(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
SHOWN = f"regexp_replace(html, '{HIDDEN}', '', 'g')"
ITEM = decoded(without_tags("x"))
ITEMS = f"""
    list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda x: trim({ITEM}))
"""
HEADINGS = ITEMS.replace("li>", "h1>")


def _parsed(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    return pages.select("page_id", "url", H.nodes(F.col("html")).alias("nodes"))


@query(f"select page_id, {decoded(without_tags(SHOWN))} as text from pages")
def page_text(spark, sf):
    return _parsed(spark, sf).select("page_id", H.visible_text(F.col("nodes")).alias("text"))


@query(f"""
    select page_id, cast(len(items) as bigint) as n, array_to_string(items, chr(10)) as items
    from (select page_id, list_filter({ITEMS}, lambda x: length(x) > 0) as items from pages)
""")
def page_list_items(spark, sf):
    texts = F.transform(H.tag_texts(F.col("nodes"), "li"), X.strip)
    items = _parsed(spark, sf).select(
        "page_id", F.filter(texts, lambda x: F.length(x) > 0).alias("items")
    )
    return items.select(
        "page_id", F.size("items").cast("bigint").alias("n"), F.array_join("items", "\n").alias("items")
    )


FIRST_LINK = decoded("""nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '')""")


@query(f"select page_id, {FIRST_LINK} as link from pages")
def page_first_link(spark, sf):
    links = H.select(F.col("nodes"), H.tagged("a"))
    return _parsed(spark, sf).select("page_id", H.first_href(links).alias("link"))


@query(f"""
    select page_id,
           case when link is null then url
                when link like 'http%' then link
                else regexp_extract(url, '^(https?://[^/?#]*)', 1) || link end as resolved,
           'https://www.dice.com/jobs/detail/' || page_id || '/?from=' || url as rewritten,
           'https://www.dice.com/jobs/detail/' || page_id || '?src=19' as detail_url,
           'https://jobs.apple.com/us/search#&ss=' || page_id as posting_url
    from (select page_id, url, {FIRST_LINK} as link from pages)
""")
def url_rewrite(spark, sf):
    number = F.col("page_id").cast("string")
    found = F.concat(F.lit("http://www.dice.com/job/result/"), number, F.lit("?src=19"))
    links = H.select(F.col("nodes"), H.tagged("a"))
    return _parsed(spark, sf).select(
        "page_id",
        U.resolve(F.col("url"), H.first_href(links)).alias("resolved"),
        U.detail_url(
            F.concat(F.lit("http://www.dice.com/job/result/"), number, F.lit("/?from="), "url")
        ).alias("rewritten"),
        U.detail_url(found).alias("detail_url"),
        U.posting_url(number).alias("posting_url"),
    )


RELATIVE = ["../c/{}", "./d?q=../{}", "/a/../b/./{}", "x/..", "../../../../up/%2E%2e/{}#../z", "{}/."]


def _dots_sql(path: str) -> str:
    """A path without dot segments, by a stack of segments."""
    parts = f"string_split({path}[2:], '/')"
    plain = "replace(replace(x[1], '%2E', '.'), '%2e', '.')"
    kept = f"""list_reduce(list_prepend([]::varchar[], list_transform({parts}, lambda s: [s])),
        lambda kept, x: case when {plain} = '..' then kept[:-2] when {plain} = '.' then kept else kept || x end)"""
    last = f"replace(replace({parts}[-1], '%2E', '.'), '%2e', '.') in ('.', '..')"
    return f"'/' || array_to_string({kept} || (case when {last} then [''] else []::varchar[] end), '/')"


@query(f"""
    with links as (
        select page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) as origin,
               coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*(/(?:[^?#]*/)?)', 1), ''), '/') as folder,
               unnest([{", ".join("'" + r.replace("{}", "' || page_id || '") + "'" for r in RELATIVE)}]) as ref
        from pages),
    parts as (select *, regexp_extract(ref, '^([^?#]*)', 1) as path from links)
    select page_id, ref, origin || {_dots_sql("(case when path[1:1] = '/' then path else folder || path end)")}
           || ref[length(path) + 1:] as resolved
    from parts
""")
def relative_links(spark, sf):
    """References with dot segments against the address of every page."""
    number = F.col("page_id").cast("string")
    made = []
    for ref in RELATIVE:
        before, _, after = ref.partition("{}")
        made.append(F.concat(F.lit(before), number, F.lit(after)) if "{}" in ref else F.lit(ref))
    pages = table(spark, sf, "pages", "page_id", "url").withColumn("ref", F.explode(F.array(*made)))
    return pages.select("page_id", "ref", U.resolve(F.col("url"), F.col("ref")).alias("resolved"))



@query(f"""
    with listed as (
        select page_id, 0 as section_no, 'Items' as type, {ITEMS} as elements from pages
        union all
        select page_id, 1, 'Headings', {HEADINGS} from pages)
    select page_id, cast(section_no as bigint) as section_no, type,
           cast(element_no - 1 as bigint) as element_no, elements[element_no] as element
    from (select *, unnest(range(1, len(elements) + 1)) as element_no from listed)
""")
def listing_elements(spark, sf):
    def section(label, tag):
        texts = F.transform(H.tag_texts(F.col("nodes"), tag), X.strip)
        return F.struct(F.lit(label).alias("type"), texts.alias("elements"))

    postings = _parsed(spark, sf).select(
        "page_id", F.array(section("Items", "li"), section("Headings", "h1")).alias("listings")
    )
    long = explode_listings(postings, ("page_id",))
    return long.withColumns(
        {c: F.col(c).cast("bigint") for c in ("section_no", "element_no")}
    )


@query(f"""
    select page_id, tag, count(*) as n from (
        select page_id, lower(unnest(regexp_extract_all(
            regexp_replace(html, '(?s)(<script[^>]*>).*?</script>|(<style[^>]*>).*?</style>|<!--.*?-->',
                           '\\1\\2', 'g'),
            '<([a-zA-Z][a-zA-Z0-9]*)', 1))) as tag
        from pages)
    group by page_id, tag
""")
def page_nodes(spark, sf):
    nodes = html_nodes(table(spark, sf, "pages", "page_id", "html"), "html", ("page_id",))
    elements = nodes.filter(F.col("tag") != H.TEXT)
    return elements.groupBy("page_id", "tag").agg(F.count("*").alias("n"))
