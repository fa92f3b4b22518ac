import random

from pyspark.sql import functions as F

from runway.operators.aggregates import argmax_by_group, top_n, top_n_sql
from runway.operators.quality import duplicate_keys, frames_equal
from runway.plans.delays import delay_by_hour, delayed_share, least_delayed_origin
from runway.plans.hours import busiest_hour
from runway.plans.routes import busiest_routes, carrier_route_vs_total, carriers_on_top_routes
from runway.plans.weather import join_weather
from runway.sources import roles

from conftest import SF_SMALL


def _hours(spark):
    rows = [("AA", 6)] * 10 + [("AA", 22)] + [("BB", 9)] * 3 + [("BB", 7)] * 3
    return spark.createDataFrame(rows, "carrier string, hour int")


def test_busiest_hour_argmax_vs_columnwise(spark):
    t = _hours(spark)
    am = {r.carrier: (r.hour, r["count"]) for r in busiest_hour(t, "carrier").collect()}
    cw = {r.carrier: (r.max_hour, r.max_count) for r in
          busiest_hour(t, "carrier", "columnwise").collect()}
    assert am == {"AA": (6, 10), "BB": (7, 3)}     # tie 7/9 -> earliest hour
    assert cw == {"AA": (22, 10), "BB": (9, 3)}


def test_top_n_ties_use_keys(spark):
    df = spark.createDataFrame([(2, 1, 5), (1, 9, 5), (1, 2, 5), (3, 3, 1)],
                               "origin int, dest int, route_freq long")
    got = [(r.origin, r.dest) for r in top_n(df, "route_freq", ["origin", "dest"], 2).collect()]
    assert got == [(1, 2), (1, 9)]
    got_sql = [(r.origin, r.dest) for r in
               top_n_sql(df, "route_freq", ["origin", "dest"], 2).collect()]
    assert sorted(got_sql) == got


def test_results_do_not_depend_on_partitioning(spark):
    t = roles.trips(spark, SF_SMALL).cache()
    base = busiest_routes(t, 5).collect()
    base_cw = carriers_on_top_routes(t, 5).collect()
    for n in (1, 3, 17):
        shuffled = t.repartition(n, F.rand(random.randint(0, 99)))
        assert busiest_routes(shuffled, 5).collect() == base
        assert carriers_on_top_routes(shuffled, 5).collect() == base_cw
    h = _hours(spark)
    a = argmax_by_group(h.groupBy("carrier", "hour").count(), "carrier", "hour", "count")
    b = argmax_by_group(h.repartition(7).groupBy("carrier", "hour").count(),
                        "carrier", "hour", "count")
    assert frames_equal(a, b)
    t.unpersist()


def test_route_properties(spark):
    t = roles.trips(spark, SF_SMALL)
    top = busiest_routes(t, 5).collect()
    per_carrier = carriers_on_top_routes(t, 5).collect()
    assert sum(r["count"] for r in per_carrier) == sum(r.route_freq for r in top)
    vs = carrier_route_vs_total(t, 5).collect()
    assert all(r["count"] <= r.count2 for r in vs)


def test_delayed_share_bounds_and_empty(spark):
    t = roles.trips(spark, SF_SMALL)
    origin = busiest_routes(t, 1).first().origin
    r = delayed_share(t, origin).first()
    assert r.total > 0 and 0.0 <= r.delayed_pct <= 100.0
    none = delayed_share(t, -12345).first()
    assert (none.total, none.delayed, none.delayed_pct) == (0, 0, None)


def test_least_delayed_origin_is_minimum(spark):
    t = roles.trips(spark, SF_SMALL)
    r = least_delayed_origin(t).first()
    counts = t.where("dep_delay > 0").groupBy("origin").count().collect()
    assert r["count"] == min(c["count"] for c in counts)


def test_repeated_weather_key_repeats_trip(spark):
    trips = spark.createDataFrame(
        [(8, __import__("datetime").date(2013, 8, 22), 1, 5, 10, 3.0, 4.0)],
        "month int, date date, origin long, hour int, flight long, dep_delay double, "
        "arr_delay double")
    w = spark.createDataFrame(
        [(1, "8-22-2013", "2013-08-22 05:00:00", 20.0, 1.0, 2.0, 3.0, 4.0, 5.0, 1000.0, 9.0)] * 2,
        "origin long, date string, hour_sched_dep string, temp double, dewp double, "
        "humid double, wind_dir double, wind_speed double, wind_gust double, "
        "pressure double, visib double")
    j = join_weather(trips, w)
    assert j.count() == 2
    assert duplicate_keys(j.select("date", "origin", "hour"), ["date", "origin", "hour"]).count() == 1
    assert join_weather(trips, w, only_delayed=True).count() == 2


def test_delay_by_hour_only_late_both_ways(spark):
    df = spark.createDataFrame([(5, 10.0, 1.0), (5, 20.0, -1.0), (5, 30.0, 2.0), (6, -1.0, 5.0)],
                               "hour int, dep_delay double, arr_delay double")
    assert [(r.hour, r.avg_delay) for r in delay_by_hour(df).collect()] == [(5, 20.0)]


def test_argmax_with_text_items(spark):
    df = spark.createDataFrame([("g", "b", 3), ("g", "a", 3), ("g", "c", 1), ("h", "z", 2)],
                               "grp string, item string, n long")
    got = {r.grp: (r.item, r.n) for r in argmax_by_group(df, "grp", "item", "n").collect()}
    assert got == {"g": ("a", 3), "h": ("z", 2)}


def test_pairwise_series(spark):
    from runway.plans.series import pairwise_series
    df = spark.createDataFrame([(1, 2.0, 10.0), (2, 4.0, 5.0), (3, 6.5, 1.0)],
                               "a int, b double, c double")
    corr, bins = pairwise_series(df, ["a", "b", "c"], bins=2)
    c = {(r.col_a, r.col_b): r.corr for r in corr.collect()}
    assert set(c) == {("a", "b"), ("a", "c"), ("b", "c")} and c[("a", "b")] > 0.99
    b = {(r.col, r.bin): r["count"] for r in bins.collect()}
    assert b[("a", 1)] == 1 and b[("a", 2)] == 2 and sum(v for (k, _), v in b.items() if k == "c") == 3


def test_cleaning_invariants_on_roles(spark):
    from runway.operators.quality import drop_null_rows, fill_group_mean, null_counts
    from runway.plans.cleaning import ROUTE_KEYS, clean_planes
    from runway.sources.schemas import FLIGHT_REQUIRED_COLUMNS
    raw = roles.clock_trips(spark, SF_SMALL)
    kept = drop_null_rows(raw, FLIGHT_REQUIRED_COLUMNS)
    nulls = null_counts(kept).first()
    assert all(nulls[c] == 0 for c in FLIGHT_REQUIRED_COLUMNS)
    filled = fill_group_mean(kept, ROUTE_KEYS, ["air_time"])
    assert filled.count() == kept.count()                       # the fill never adds rows
    before = {r.flight: r.air_time for r in kept.collect()}
    after = {r.flight: r.air_time for r in filled.collect()}
    assert all(after[f] == v for f, v in before.items() if v is not None)   # known values kept
    assert null_counts(filled).first().air_time <= null_counts(kept).first().air_time
    planes = clean_planes(roles.fleet(spark, SF_SMALL))
    assert "speed" not in planes.columns
    assert all(v == 0 for v in null_counts(planes).first().asDict().values())


def test_weather_join_fallback_equals_broadcast(spark):
    from runway import catalog
    f, w = catalog.flights(spark, SF_SMALL), catalog.weather(spark, SF_SMALL)
    a = join_weather(f, w)
    b = join_weather(f, w, max_weather_rows=0)     # over the bound: shuffle join
    assert a.count() > 0 and frames_equal(a, b)
