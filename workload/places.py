"""Postings per place and week, over customers and events."""

from pyspark.sql import functions as F

from vacantia.operators import heat
from workload.registry import query, table


def company_sites(spark, sf):
    """Customers as geolocated company postings: the segment posts at the nation."""
    nation = table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    return (
        table(spark, sf, "customer", "c_mktsegment", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_mktsegment").alias("company"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.col("n_regionkey").cast("double").alias("longitude"),
        )
    )


def dated_sites(spark, sf):
    """Events as geolocated aggregator postings."""
    return table(spark, sf, "events", "ts", "user_id").select(
        F.to_date("ts").alias("date_posted"),
        (F.col("user_id") % 10).cast("double").alias("latitude"),
        (F.col("user_id") % 7).cast("double").alias("longitude"),
    )


COMPANY_SITES = """
    select c_mktsegment as company, cast(n_nationkey as double) as latitude,
           cast(n_regionkey as double) as longitude
    from customer join nation on c_nationkey = n_nationkey
"""

WEEKS = """
    select cast(date_diff('day', cast(ts as date), (select max(cast(ts as date)) from events)) // 7
                as bigint) as wk,
           cast(user_id % 10 as double) as latitude, cast(user_id % 7 as double) as longitude
    from events
"""

SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


@query(f"""
    select company, latitude, longitude, count(*) as quantity
    from ({COMPANY_SITES}) group by company, latitude, longitude
""")
def company_site_counts(spark, sf):
    return heat.site_counts(company_sites(spark, sf))


@query(f"""
    select latitude, longitude, cast(count(*) as bigint) as quantity
    from ({COMPANY_SITES}) where company in ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
    group by latitude, longitude
""")
def selected_company_heat(spark, sf):
    return heat.selected_heat(heat.site_counts(company_sites(spark, sf)), SEGMENTS)


@query(f"""
    select wk as week, latitude, longitude, count(*) as quantity
    from ({WEEKS}) group by wk, latitude, longitude
""")
def weekly_site_counts(spark, sf):
    weeks = heat.week_counts(dated_sites(spark, sf))
    return weeks.withColumn("week", F.col("week").cast("bigint"))


@query(f"select distinct latitude, longitude from ({WEEKS})")
def site_list(spark, sf):
    return heat.site_list(dated_sites(spark, sf))


@query(f"""
    select latitude, longitude, cast(0 as bigint) as "A",
           count(*) filter (where wk = 0) as "B", count(*) filter (where wk <= 1) as "C",
           count(*) filter (where wk <= 2) as "D", count(*) filter (where wk <= 3) as "E",
           count(*) filter (where wk <= 4) as "F"
    from ({WEEKS}) group by latitude, longitude
""")
def weekly_cumulative_wide(spark, sf):
    return heat.site_index(heat.aged_sites(dated_sites(spark, sf)))


@query(f"""
    with weeks as ({WEEKS}),
    grid as (
        select latitude, longitude, wk
        from (select distinct latitude, longitude from weeks), range(5) as g(wk)
    ),
    counts as (select wk, latitude, longitude, count(*) as n from weeks group by all)
    select latitude, longitude, cast(wk as bigint) as week,
           cast(sum(coalesce(n, 0)) over (partition by latitude, longitude order by wk) as bigint)
               as total
    from grid left join counts using (latitude, longitude, wk)
""")
def weekly_cumulative_long(spark, sf):
    long = heat.site_index(heat.aged_sites(dated_sites(spark, sf)), form="long")
    return long.withColumn("week", F.col("week").cast("bigint"))


@query(f"""
    select longitude, latitude, count(*) filter (where wk between 1 and 3) as quantity
    from ({WEEKS}) group by longitude, latitude
""")
def heat_week_range(spark, sf):
    return heat.heat_range(heat.site_index(heat.aged_sites(dated_sites(spark, sf))), 1, 4)


ORDER_WEEKS = """
    select cast(date_diff('day', cast(o_orderdate as date), (select max(cast(o_orderdate as date)) from orders)) // 7
                as bigint) as wk,
           cast(c_nationkey as double) as latitude, cast(o_custkey % 5 as double) as longitude
    from orders join customer on o_custkey = c_custkey
"""


def order_sites(spark, sf):
    """Orders as geolocated aggregator postings of several years."""
    customers = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders", "o_custkey", "o_orderdate")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderdate").cast("date").alias("date_posted"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        (F.col("o_custkey") % 5).cast("double").alias("longitude"),
    )


@query(f"""
    select longitude, latitude, count(*) filter (where wk between 20 and 79) as quantity
    from ({ORDER_WEEKS}) group by longitude, latitude
""")
def long_heat_range(spark, sf):
    """Sixty weeks out of several hundred, from the sparse long form."""
    return heat.heat_range(heat.site_prefix(heat.aged_sites(order_sites(spark, sf))), 20, 80)


@query(f"""
    with weeks as (select latitude, longitude, wk, count(*) as n from ({ORDER_WEEKS}) where wk >= 0 group by all)
    select latitude, longitude, wk as week,
           cast(sum(n) over (partition by latitude, longitude order by wk) as bigint) as total
    from weeks
""")
def long_cumulative(spark, sf):
    """Cumulative postings of every week that has any, over several hundred weeks."""
    prefix = heat.site_prefix(heat.aged_sites(order_sites(spark, sf)))
    return prefix.withColumn("week", F.col("week").cast("bigint"))
