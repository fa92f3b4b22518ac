"""Stored join sides, dictionary decoding, checked CSV, two scopes, signed
differences, mergeable means and one row per key."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from runway import catalog
from runway.functions.clock import parse_date
from runway.functions.dictionary import decoded
from runway.operators.means import (fill_from_state, load_state, mean_state, merged_states, save_state,
                                    without_state)
from runway.operators.quality import fill_group_mean, frame_difference, frames_equal, one_per_key
from runway.plans.routes import carrier_route_vs_total, carriers_on_top_routes
from runway.plans.weather import JOIN_KEYS, join_stored_weather, join_weather, store_weather_join
from runway.session import scratch_path, scratch_scope, written
from runway.sources.csv import read_csv_checked
from runway.sources.schemas import FLIGHTS
from runway.sources.store import store_join_sides
from test_skew import conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def rows(df):
    return Counter(map(tuple, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- stored sides ----------------------------------------------------------------

def test_stored_weather_join_has_no_exchange(spark):
    trips, wx = catalog.flights(spark, SF_SMALL), catalog.weather(spark, SF_SMALL)
    with conf(spark, NO_BROADCAST):
        joined = join_stored_weather(store_weather_join(trips, wx))
        plan = plan_of(joined)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
        assert rows(catalog.r4(joined)) == rows(catalog.r4(join_weather(trips, wx)))
        late = join_stored_weather(store_weather_join(trips, wx), only_delayed=True)
        assert "Exchange" not in plan_of(late)
    assert rows(catalog.r4(late)) == rows(catalog.r4(join_weather(trips, wx, only_delayed=True)))


def test_storing_the_sides_is_three_writes(spark):
    """Hot keys, left and right: three tables, counted in the shared folder's paths."""
    import runway.session as session
    trips, wx = written(catalog.flights(spark, SF_SMALL), "t"), written(catalog.weather(spark, SF_SMALL), "w")
    made = []
    session._scopes.append(made)
    try:
        store_weather_join(trips, wx)
    finally:
        session._scopes.pop()
    assert len(made) == 3


def test_hot_key_is_dealt_over_parts(spark):
    """A third of all rows has one key: no bucket holds it whole, every pair meets once."""
    left = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 700 END AS k", "id")
    left = left.unionByName(spark.createDataFrame([(None, -1), (0, 0), (0, 0)], "k long, id long"))
    right = spark.range(800).selectExpr("id AS k", "id * 10 AS v").unionByName(
        spark.createDataFrame([(0, 1), (None, 2)], "k long, v long"))
    with conf(spark, NO_BROADCAST):
        sides = store_join_sides(left, right, ["k"], buckets=8, max_key_rows=500)
        assert "Exchange" not in plan_of(sides.joined())
        assert rows(sides.joined()) == rows(left.join(right, "k"))
        parts = sides.left.where("k = 0").groupBy("__join_part").count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < 900
    assert sides.left.count() == left.count() and sides.left.where("k is null").count() == 1


def test_stored_sides_of_empty_tables(spark):
    none = spark.createDataFrame([], "k long, id long")
    some = spark.createDataFrame([(1, 2)], "k long, v long")
    assert store_join_sides(none, some, ["k"]).joined().collect() == []
    assert store_join_sides(some, none, ["k"]).joined().columns == ["k", "v", "id"]


# -- dictionary ------------------------------------------------------------------

def test_dates_are_parsed_once_per_text(spark):
    f = catalog.flights(spark, SF_SMALL)
    assert not re.search(r"gettimestamp|to_date|to_timestamp", plan_of(f), re.I)
    late = plan_of(f.where("dep_delay > 0 and arr_delay > 0").groupBy("hour").avg("dep_delay"))
    assert not re.search(r"gettimestamp|to_date|to_timestamp", late, re.I)
    raw = spark.createDataFrame([(1, "1/2/2013", "x"), (2, None, "y"), (3, "no date", None), (4, "1/2/2013", "x")],
                                "id int, date string, __dictionary_value2 string")
    seen = spark.sparkContext.accumulator(0)
    out = decoded(raw, "date", lambda c: parse_date(c))
    assert out.columns == raw.columns and seen.value == 0
    got = {r["id"]: r["date"] for r in out.collect()}
    assert str(got[1]) == str(got[4]) == "2013-01-02" and got[2] is None and got[3] is None
    assert decoded(raw.limit(0), "date", lambda c: parse_date(c)).collect() == []


# -- checked CSV -----------------------------------------------------------------

def test_checked_csv_splits_rows_and_rejects(spark, tmp_path):
    head = ",".join(FLIGHTS.names)
    good = "1/1/2013,517,533,819,811,UA,1545,N14228,EWR,IAH,227"
    for name, lines in (("a.csv", [head, good, good.replace("517", "5h17").replace("227", "long"), good + ",more"]),
                        ("b.csv", [head, good.replace("533", "NA"), "1/1/2013,517", good.replace("1545", "1545.0"),
                                   good.replace("UA", '"U,A"')])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    ok, rejects = read_csv_checked(spark, str(tmp_path), FLIGHTS)
    assert ok.schema == FLIGHTS
    got = sorted((r["dep_time"] or 0, r["carrier"], r["flight"], r["air_time"]) for r in ok.collect())
    assert got == [(0, "UA", 1545, 227.0), (533, "U,A", 1545, 227.0), (533, "UA", 1545, 227.0), (533, "UA", 1545, 227.0)]
    bad = rows(rejects.select(F.substring_index("file", "/", -1), "column", "cell"))
    assert bad == Counter([("a.csv", "sched_dep_time", "5h17"), ("a.csv", "air_time", "long"), ("a.csv", None, None),
                           ("b.csv", None, None)])
    assert {r["row_text"] for r in rejects.collect()} >= {good + ",more", "1/1/2013,517"}
    for df, part in ((ok, "true"), (rejects, "false")):
        files = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
        assert files and all(f"good={part}" in f for f in files)


def test_checked_csv_of_headers_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(FLIGHTS.names) + "\n")
    ok, rejects = read_csv_checked(spark, str(tmp_path), FLIGHTS)
    assert ok.collect() == [] and rejects.collect() == []


# -- two scopes ------------------------------------------------------------------

def test_ranking_year_and_counted_years(spark):
    trips = spark.createDataFrame(
        [("A", "B", "x", 2013)] * 3 + [("A", "B", "y", 2012)] * 5 + [("C", "D", "x", 2012)] * 10 + [("E", "F", "x", 2013)] * 2
        + [("E", "F", None, None), ("A", "B", "x", None)], "origin string, dest string, carrier string, year int")
    got = rows(carriers_on_top_routes(trips, 2, rank_year=2013))
    assert got == Counter([("A", "B", "x", 4), ("A", "B", "y", 5), ("E", "F", "x", 2), ("E", "F", None, 1)])
    # a route without trips in that year is none of the busiest, however small k is
    assert rows(carriers_on_top_routes(trips, 9, rank_year=2013)) == got
    assert ("C", "D", "x", 10) in rows(carriers_on_top_routes(trips, 1))
    totals = {r["carrier"]: r["count2"] for r in carrier_route_vs_total(trips, 2, rank_year=2013).collect()}
    assert totals == {"x": 16, "y": 5}


def test_months_of_both_scopes(spark):
    r = catalog.QUERIES["monthly_weather_delay_scopes"](spark, SF_SMALL).collect()
    assert len(r) == 12 and all(0 < x["late_trips"] < x["trips"] for x in r)
    late = {x["month"]: x["avg_dep_delay"] for x in catalog.QUERIES["monthly_weather_delay_late"](spark, SF_SMALL).collect()}
    assert {x["month"]: x["late_dep_delay"] for x in r} == late


# -- signed differences ------------------------------------------------------------

def test_frame_difference(spark):
    kind = "k int, v double"
    a = spark.createDataFrame([(1, 1.0), (1, 1.0), (None, None), (2, float("nan")), (3, 0.0)], kind)
    b = spark.createDataFrame([(1.0, 1), (None, None), (float("nan"), 2), (-0.0, 3), (5.0, 5), (5.0, 5)], "v double, k int")
    assert rows(frame_difference(a, b)) == Counter([(1, 1.0, 1), (5, 5.0, -2)])
    assert frames_equal(a, a.orderBy("k")) and not frames_equal(a, a.union(a))
    assert rows(frame_difference(a.limit(0), b.limit(1))) and frames_equal(a.limit(0), b.limit(0))
    assert plan_of(frame_difference(a, b)).count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        frame_difference(a, b.withColumnRenamed("v", "w"))


# -- mergeable means ---------------------------------------------------------------

def test_states_of_parts_merge_to_the_whole(spark):
    raw = catalog.raw_flights(spark, SF_SMALL)
    keys, cols = list(catalog.ROUTE_KEYS), ["air_time"]
    path = scratch_path(spark, "states")
    days = [raw.where(F.col("flight") % 3 == i) for i in range(3)]
    for i, day in enumerate(days):
        save_state(mean_state(day, keys, cols), path, f"day{i}")
    save_state(mean_state(days[1], keys, cols), path, "day1")     # a part saved again replaces itself
    whole = mean_state(raw, keys, cols)
    assert rows(catalog.r4(load_state(spark, path, keys))) == rows(catalog.r4(whole))
    filled = fill_from_state(raw, load_state(spark, path, keys), keys, cols)
    assert rows(catalog.r4(filled)) == rows(catalog.r4(fill_group_mean(raw, keys, cols)))
    rest = without_state(whole, mean_state(days[0], keys, cols), keys)
    assert rows(catalog.r4(rest)) == rows(catalog.r4(merged_states([mean_state(d, keys, cols) for d in days[1:]], keys)
                                                     .where("n_air_time > 0")))


def test_states_with_gaps(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), (None, 4.0), (None, None), ("b", None)], "n_key string, v double")
    out = fill_from_state(df, mean_state(df, ["n_key"], ["v"]), ["n_key"], ["v"])
    assert rows(out) == Counter([("a", 1.0), ("a", 1.0), ("a", 1.0), (None, 4.0), (None, None), ("b", None)])
    two = merged_states([mean_state(df, ["n_key"], ["v"])] * 2, ["n_key"])
    assert {r["n_key"]: r["n_v"] for r in two.collect()} == {"a": 2, "b": 0, None: 2}
    none = df.limit(0)
    assert mean_state(none, ["n_key"], ["v"]).collect() == [] and fill_from_state(none, mean_state(df, ["n_key"], ["v"]), ["n_key"], ["v"]).collect() == []


# -- one row per key ---------------------------------------------------------------

def test_one_per_key_takes_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", 5, None), (1, "b", 7, "x"), (1, "c", 7, "y"), (2, "d", None, None), (2, None, 1, None),
                                (None, "e", 3, "z"), (None, "f", 2, "z")], "k int, v string, at int, `odd name` string")
    got = rows(one_per_key(df, ["k"], [F.col("at")]))
    assert got == Counter([(1, "c", 7, "y"), (2, None, 1, None), (None, "e", 3, "z")])
    assert rows(one_per_key(df.repartition(5), ["k"], [F.col("at")])) == got
    assert one_per_key(df, ["k"], [F.col("at")]).columns == df.columns
    assert one_per_key(df.limit(0), ["k"], [F.col("at")]).collect() == []
    assert "Window" not in plan_of(one_per_key(df, ["k"], [F.col("at")]))


def test_repeated_weather_keys(spark):
    q = catalog.QUERIES
    assert q["weather_duplicate_keys"](spark, SF_SMALL).count() > 0
    latest = q["weather_latest_report"](spark, SF_SMALL)
    assert latest.groupBy(*JOIN_KEYS).count().where("count > 1").isEmpty()
    assert q["join_weather_reports"](spark, SF_SMALL).count() > q["join_weather_latest_report"](spark, SF_SMALL).count()


def test_scratch_scope_frees_its_tables(spark):
    import os
    with scratch_scope(spark):
        path = scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        with scratch_scope(spark):
            inner = scratch_path(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(inner.removeprefix("file:")) and os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_dropping_a_column_that_is_not_there_is_an_error(spark):
    from runway.operators.quality import drop_columns
    df = spark.range(1).withColumn("x", F.lit(1))
    assert drop_columns(df, ["x"]).columns == ["id"]
    with pytest.raises(ValueError, match="y"):
        drop_columns(df, ["x", "y"])
