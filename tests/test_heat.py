import datetime
import random

import pytest
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.operators import heat

NEWEST = datetime.date(2017, 3, 1)


def ago(days):
    return NEWEST - datetime.timedelta(days)


SITES = [
    *((ago(d), 1.0, 2.0) for d in (0, 6, 7, 34, 35, 60)),
    (ago(60), 3.0, 4.0),
    (ago(0), None, 4.0),
    (ago(8), None, 4.0),
    (None, 1.0, 2.0),
    (None, 9.0, 9.0),
]


@pytest.fixture(scope="module")
def sites(spark):
    return spark.createDataFrame(SITES, schemas.AGGREGATOR_SITE)


def by_place(df, *columns):
    return {(r.latitude, r.longitude): tuple(r[c] for c in columns) for r in df.collect()}


def test_week_counts(sites):
    rows = {(r.week, r.latitude, r.longitude): r.quantity for r in heat.week_counts(sites).collect()}
    assert rows == {
        (0, 1.0, 2.0): 2, (1, 1.0, 2.0): 1, (4, 1.0, 2.0): 1, (5, 1.0, 2.0): 1, (8, 1.0, 2.0): 1,
        (8, 3.0, 4.0): 1, (0, None, 4.0): 1, (1, None, 4.0): 1, (None, 1.0, 2.0): 1,
        (None, 9.0, 9.0): 1,
    }


WANT = {
    (1.0, 2.0): (0, 2, 3, 3, 3, 4),
    (3.0, 4.0): (0, 0, 0, 0, 0, 0),
    (None, 4.0): (0, 1, 2, 2, 2, 2),
    (9.0, 9.0): (0, 0, 0, 0, 0, 0),
}


def test_site_index(sites):
    wide = heat.site_index(heat.week_counts(sites))
    assert wide.columns == ["latitude", "longitude", "A", "B", "C", "D", "E", "F"]
    assert by_place(wide, *"ABCDEF") == WANT
    assert by_place(heat.site_index(heat.aged_sites(sites)), *"ABCDEF") == WANT
    assert by_place(heat.site_list(sites)) == {k: () for k in WANT}


def test_long_form_agrees_with_wide(sites):
    long = heat.site_index(heat.week_counts(sites), form="long").collect()
    assert {(r.latitude, r.longitude, r.week): r.total for r in long} == {
        (*place, week): totals[week + 1] for place, totals in WANT.items() for week in range(5)
    }
    with pytest.raises(ValueError):
        heat.site_index(heat.week_counts(sites), form="tall")


def test_range_is_the_direct_count_and_adds_up(spark):
    rng = random.Random(7)
    rows = [(ago(rng.randrange(50)), float(rng.randrange(4)), float(rng.randrange(3)))
            for _ in range(400)]
    sites = spark.createDataFrame(rows, schemas.AGGREGATOR_SITE)
    newest = max(r[0] for r in rows)
    index = heat.site_index(heat.week_counts(sites)).cache()
    ranges = {}
    for lo in range(6):
        for hi in range(lo, 6):
            found = by_place(heat.heat_range(index, lo, hi), "quantity")
            ranges[lo, hi] = {k: v[0] for k, v in found.items()}
            for lat, lon in found:
                direct = sum(
                    lo <= (newest - d).days // 7 < hi for d, la, lo_ in rows if (la, lo_) == (lat, lon)
                )
                assert ranges[lo, hi][lat, lon] == direct
    for place in ranges[0, 5]:
        assert ranges[0, 2][place] + ranges[2, 5][place] == ranges[0, 5][place]
        assert ranges[3, 3][place] == 0


@pytest.mark.parametrize("lo,hi", [(-1, 2), (3, 2), (0, 6)])
def test_range_bounds(sites, lo, hi):
    with pytest.raises(ValueError):
        heat.heat_range(heat.site_index(heat.week_counts(sites)), lo, hi)


def test_fixed_newest_date(sites):
    counts = heat.week_counts(sites, max_date=datetime.date(2017, 3, 8))
    assert counts.agg(F.min("week")).first()[0] == 1


def test_selected_companies(spark):
    rows = [("a", 1.0, 2.0), ("a", 1.0, 2.0), ("b", 1.0, 2.0), ("b", None, 2.0), ("c", 1.0, 2.0)]
    counts = heat.site_counts(spark.createDataFrame(rows, schemas.COMPANY_SITE))
    assert {(r.company, r.latitude): r.quantity for r in counts.collect()} == {
        ("a", 1.0): 2, ("b", 1.0): 1, ("b", None): 1, ("c", 1.0): 1}
    assert by_place(heat.selected_heat(counts, ["a", "b"]), "quantity") == {
        (1.0, 2.0): (3,), (None, 2.0): (1,)}
    assert heat.selected_heat(counts, []).collect() == []
    assert heat.selected_heat(counts, ["z"]).collect() == []


def test_one_shuffle_for_the_index(sites):
    plan = heat.site_index(heat.aged_sites(sites))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_long_tables_have_names_and_ranges_of_any_length(spark):
    names = heat.week_columns(60)
    assert names[25:29] == ["Z", "AA", "AB", "AC"] and names[52] == "BA" and len(set(names)) == 61
    rng = random.Random(3)
    rows = [(ago(rng.randrange(2_100)), float(rng.randrange(3)), None if rng.random() < 0.2 else 1.0) for _ in range(300)]
    rows += [(None, 9.0, 9.0), (ago(0), 1.0, 1.0)]
    sites = spark.createDataFrame(rows, schemas.AGGREGATOR_SITE)
    prefix = heat.site_prefix(heat.aged_sites(sites)).cache()
    assert by_place(prefix.filter("latitude = 9"), "week", "total") == {(9.0, 9.0): (-1, 0)}
    wide = heat.site_index(heat.aged_sites(sites), 60).cache()
    for lo, hi in ((0, 0), (0, 1), (5, 60), (7, 8), (59, 60), (0, 60)):
        assert by_place(heat.heat_range(prefix, lo, hi), "quantity") == by_place(heat.heat_range(wide, lo, hi), "quantity")
    newest = max(r[0] for r in rows if r[0])
    found = by_place(heat.heat_range(prefix, 100, 300), "quantity")
    for place, (n,) in found.items():
        assert n == sum(d is not None and 100 <= (newest - d).days // 7 < 300 for d, *p in rows if tuple(p) == place)
    assert by_place(heat.heat_range(heat.site_prefix(heat.week_counts(sites)), 3, 40), "quantity") == by_place(heat.heat_range(prefix, 3, 40), "quantity")
    with pytest.raises(ValueError):
        heat.heat_range(prefix, 3, 2)
