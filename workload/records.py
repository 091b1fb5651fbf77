"""Dedupe, joins against stored ids and details, filters, fields, and the outcome tally."""

from pyspark.sql import functions as F

from vacantia.functions import json as J
from vacantia.functions import text as X
from vacantia.operators.dedupe import first_seen as keep_first
from vacantia.operators.dedupe import only_new
from vacantia.operators.details import list_detail as join_details
from vacantia.operators.outcomes import outcomes as tally_outcomes
from vacantia.plans import apple
from vacantia.sources.sinks import filled
from workload.registry import query, table


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as day,
           l_quantity
    from (select *, row_number() over (
              partition by l_orderkey
              order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) as rn
          from lineitem)
    where rn = 1
""")
def first_seen(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    first = keep_first(table(spark, sf, "lineitem", "l_orderkey", *order), ["l_orderkey"], order)
    return first.withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query("""
    select o_orderkey as job_id, o_orderstatus from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def unseen_postings(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), "o_orderstatus")
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"))
    return only_new(orders, seen, ["job_id"])


@query("""
    select o_custkey as list_id, o_orderkey, o_orderstatus, c_name, c_mktsegment
    from orders join customer on o_custkey = c_custkey
""")
def list_detail(spark, sf):
    listed = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("list_id"), "o_orderkey", "o_orderstatus"
    )
    details = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("list_id"), "c_name", "c_mktsegment"
    )
    return join_details(listed, details, ["list_id"])


@query("""
    with claims as (
        select source, copies, case when k < 20 then 'rejected' else 'accepted' end as outcome
        from (select event_type as source, cast(json_extract_string(props, '$.k') as bigint) as k,
                     row_number() over (partition by event_type, user_id order by event_id) as rn,
                     count(*) over (partition by event_type, user_id) as copies
              from events)
        where rn = 1
    )
    select source, outcome, count(*) as n from claims group by source, outcome
    union all
    select source, 'duplicate', cast(sum(copies - 1) as bigint) from claims
    group by source having sum(copies - 1) > 0
""")
def outcomes(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), "user_id", "event_id", "props"
    )
    claims = keep_first(events, ["source", "user_id"], ["event_id"], copies="copies")
    small = J.json_field(F.col("props"), "k").cast("bigint") < 20
    outcome = F.when(small, F.lit("rejected")).otherwise(F.lit("accepted"))
    return tally_outcomes(claims.select("source", "copies", outcome.alias("outcome"), F.lit(True).alias("claimed")))


@query("select p_partkey, p_brand from part where p_brand like 'Brand#1%'")
def country_prefix(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_brand")
    return part.filter(X.in_country(F.col("p_brand"), "Brand#1"))


@query("""
    select c_custkey, place from (
        select c_custkey,
               case c_custkey % 3 when 0 then c_name || ', ' || substr(c_mktsegment, 1, 2)
                                  when 1 then c_name || ', ' || c_mktsegment
                                  else c_name || ', Fr' end as place
        from customer)
    where c_custkey % 3 <> 2
""")
def place_pattern(spark, sf):
    end = (
        F.when(F.col("c_custkey") % 3 == 0, F.substring("c_mktsegment", 1, 2))
        .when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment"))
        .otherwise(F.lit("Fr"))
    )
    places = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey", F.concat("c_name", F.lit(", "), end).alias("place")
    )
    return places.filter(X.names_a_state(F.col("place")))


@query("""
    select doc_id, n_chars from documents
    where regexp_matches(
        text || ', ' || case when doc_id % 2 = 0 then upper(lang) else lang end, ', [A-Z][A-Z]')
""")
def place_in_text(spark, sf):
    lang = F.when(F.col("doc_id") % 2 == 0, F.upper("lang")).otherwise(F.col("lang"))
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "n_chars")
    return docs.filter(X.names_a_state(F.concat("text", F.lit(", "), lang))).select(
        "doc_id", "n_chars"
    )


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_field(spark, sf):
    events = table(spark, sf, "events", "event_id", "props")
    return events.select("event_id", J.json_field(F.col("props"), "k").alias("k"))


@query("""
    select event_id, coalesce(json_extract_string(props, '$.z'), '') as z,
           coalesce(json_extract_string(props, '$.k'), '') as k
    from events
""")
def json_default(spark, sf):
    events = table(spark, sf, "events", "event_id", "props")
    return events.select(
        "event_id",
        J.json_default(F.col("props"), "z").alias("z"),
        J.json_default(F.col("props"), "k").alias("k"),
    )


@query("""
    select event_id, 'Description' as type, event_type as element from events
    union all
    select event_id, 'Qualifications', props from events where user_id % 2 = 0
""")
def section_lookup(spark, sf):
    fields = F.to_json(
        F.struct(
            F.col("event_type").alias("description"),
            F.col("value").alias("educationDetails"),
            F.when(F.col("user_id") % 2 == 0, F.col("props")).alias("keyQualifications"),
            F.col("props").alias("somethingElse"),
        )
    )
    events = table(spark, sf, "events", "event_id", "event_type", "value", "user_id", "props")
    made = events.select("event_id", F.try_parse_json(fields).alias("doc"))
    return made.select("event_id", F.inline(apple.sections(F.col("doc")))).select(
        "event_id", "type", F.explode("elements").alias("element")
    )


@query("""
    select cast(doc_id as varchar) as doc_id, lang, d.source,
           coalesce(cast(quality as varchar), '') as quality,
           coalesce(cast(toxic as varchar), '') as toxic, '' as company_intro,
           '[{"type":"' || lang || '","elements":["' || d.source || '"]}]' as listings
    from documents d left join labels using (doc_id)
""")
def posting_table(spark, sf):
    section = F.struct(F.col("lang").alias("type"), F.array("source").alias("elements"))
    docs = table(spark, sf, "documents", "doc_id", "lang", "source")
    rows = docs.join(table(spark, sf, "labels", "doc_id", "quality", "toxic"), "doc_id", "left")
    return filled(
        rows.withColumn("listings", F.array(section)),
        ["doc_id", "lang", "source", "quality", "toxic", "company_intro", "listings"],
    )
