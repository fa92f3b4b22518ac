import math

from pyspark.sql import functions as F

from runway.operators.quality import (column_profile, distinct_values, drop_null_rows,
                                      drop_sparse_columns, duplicate_keys, fill_group_mean,
                                      fill_mean, frames_equal, group_mean, null_counts,
                                      null_pct, preview, sentinel_counts,
                                      sparse_columns)
from runway.sources.csv import read_csv
from runway.sources.schemas import WEATHER
from runway.sources.roles import weather_text


def test_group_mean_fill_with_na_text(spark, tmp_path):
    p = tmp_path / "w.csv"
    p.write_text("origin,date,temp\n1,d1,39\n1,d1,NA\n1,d1,41\n2,d1,NA\n")
    df = spark.read.schema("origin long, date string, temp double") \
        .option("header", True).option("nullValue", "NA").csv(str(p))
    out = fill_group_mean(df, ["origin", "date"], ["temp"]).orderBy("origin", "temp").collect()
    assert [r.temp for r in out if r.origin == 1] == [39.0, 40.0, 41.0]
    assert [r.temp for r in out if r.origin == 2] == [None]
    assert df.columns == fill_group_mean(df, ["origin", "date"], ["temp"]).columns


def test_null_key_not_filled(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 1, 5.0), ("US", 1, None), ("US", 1, 3.0)],
                               "carrier string, origin int, air_time double")
    out = fill_group_mean(df, ["carrier", "origin"], ["air_time"]).collect()
    nulls = [r.air_time for r in out if r.carrier is None]
    assert sorted(nulls, key=lambda v: v is None) == [5.0, None]
    assert sorted(r.air_time for r in out if r.carrier == "US") == [3.0, 3.0]


def test_fill_group_mean_shuffle_path_equals_broadcast_path(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("k"),
                                     F.when(F.col("id") % 5 != 0, F.col("id") * 1.5).alias("v"))
    a = fill_group_mean(df, ["k"], ["v"])                 # checked, small -> broadcast
    b = fill_group_mean(df, ["k"], ["v"], max_groups=0)   # over the bound -> shuffle join
    assert frames_equal(a, b)
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()


def test_group_mean_keeps_rows_and_order(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    out = group_mean(df, ["k"], "v")
    assert out.columns == ["k", "v", "mean_v"]
    assert sorted((r.k, r.mean_v) for r in out.collect()) == [("a", 2.0), ("a", 2.0), ("b", None)]


def test_sparse_threshold_is_strict(spark):
    rows = [(i, None if i < 70 else 1, None if i < 71 else 1) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, at70 int, at71 int")
    assert sparse_columns(df, 70.0) == ["at71"]
    assert drop_sparse_columns(df).columns == ["id", "at70"]
    pct = null_pct(df).first()
    assert (pct.id, pct.at70, pct.at71) == (0.0, 70.0, 71.0)


def test_null_pct_empty_is_null(spark):
    df = spark.createDataFrame([], "a int")
    assert null_pct(df).first().a is None


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "a double, b string")
    r = null_counts(df).first()
    assert (r.a, r.b) == (2, 1)


def test_sentinel_counts(spark):
    df = spark.createDataFrame([("NA", 1), ("3", 2), ("NA", None)], "a string, b int")
    r = sentinel_counts(df, "NA").first()
    assert (r.a, r.b) == (2, 0)


def test_weather_text_then_typed_read(spark, tmp_path):
    rows = [("1", "8-22-2013", "2013-08-22 05:00:00") + (None,) * 7 + (3.0,)]
    df = spark.createDataFrame(rows, WEATHER)
    txt = weather_text(df)
    assert sentinel_counts(txt).first().temp == 1
    out = str(tmp_path / "w")
    txt.write.option("header", True).csv(out)
    back = read_csv(spark, out, WEATHER, "NA")
    assert back.first().temp is None and back.first().visib == 3.0


def test_drop_null_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, None), (3, 4.0, "c")],
                               "id int, x double, t string")
    assert [r.id for r in drop_null_rows(df, ["x"]).collect()] == [2, 3]
    assert [r.id for r in drop_null_rows(df).collect()] == [3]


def test_fill_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert sorted(r.v for r in fill_mean(df, ["v"]).collect()) == [1.0, 2.0, 3.0]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {(r.column_name, r.data_type, r.non_null) for r in column_profile(df).collect()}
    assert got == {("a", "int", 2), ("b", "string", 1)}


def test_distinct_and_duplicates(spark):
    df = spark.createDataFrame([("EWR", 1), ("EWR", 1), ("JFK", 2)], "o string, k int")
    assert distinct_values(df, F.col("o") == "EWR", ["o", "k"]).count() == 1
    d = duplicate_keys(df, ["o", "k"]).collect()
    assert [(r.o, r.k, r.n) for r in d] == [("EWR", 1, 2)]


def test_frames_equal_respects_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert frames_equal(a, a) and not frames_equal(a, b)
    assert not math.isnan(1.0)


def test_preview(spark):
    df = spark.range(100)
    assert preview(df, 5).count() == 5 and preview(df).columns == ["id"]


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "carrier string, origin int, air_time double")
    assert fill_group_mean(df, ["carrier", "origin"], ["air_time"]).count() == 0
    assert fill_mean(df, ["air_time"]).count() == 0
    assert drop_sparse_columns(df).columns == df.columns
    assert null_counts(df).first().air_time == 0
    assert group_mean(df, ["carrier"], "air_time").count() == 0


def test_nan_is_missing_in_fills(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", float("nan"))],
                               "k string, v double")
    got = sorted((r.k, r.v) for r in fill_group_mean(df, ["k"], ["v"]).collect()
                 if r.k == "a")
    assert got == [("a", 1.0), ("a", 2.0), ("a", 3.0)]
    b = [r.v for r in fill_group_mean(df, ["k"], ["v"]).collect() if r.k == "b"]
    assert b == [None]
    assert sorted(r.v for r in fill_mean(df, ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]


def test_bounded_join_checks_bytes_too(spark):
    from runway.operators.joins import join_bounded, row_bytes
    big = spark.range(100).select((F.col("id") % 10).alias("k"))
    small = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 50).alias("s"))
    assert small.select(row_bytes(small).alias("b")).first().b == 40 + 8 + 2 * 8 + 57  # entry, null bits, fields, text in words
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint broadcasts
    try:
        a = join_bounded(big, small, ["k"], "left")
        b = join_bounded(big, small, ["k"], "left", max_bytes=100)   # 660 bytes > 100
        plan_a = a._jdf.queryExecution().executedPlan().toString()
        plan_b = b._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan_a
        assert "BroadcastHashJoin" not in plan_b and "SortMergeJoin" in plan_b
        assert frames_equal(a, b)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_profiles_quote_odd_column_names(spark):
    df = spark.createDataFrame([("x", None, 1.0), ("it's", "a", None)],
                               "`a b` string, `x``y` string, `it's` double")
    assert null_counts(df).first().asDict() == {"a b": 0, "x`y": 1, "it's": 1}
    assert sentinel_counts(df, "it's").first().asDict() == {"a b": 1, "x`y": 0, "it's": 0}
    assert null_pct(df).first()["x`y"] == 50.0
    prof = {r.column_name: (r.data_type, r.non_null) for r in column_profile(df).collect()}
    assert prof == {"a b": ("string", 2), "x`y": ("string", 1), "it's": ("double", 1)}


def test_verdict_edge_cases(spark):
    from runway.operators.aggregates import argmax_by_group
    from runway.operators.quality import column_profile, drop_null_rows
    from runway.plans.series import binned_counts
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, float("nan")), ("a", 3, None)], "k string, item int, x double")
    assert {r.column_name: r.non_null for r in column_profile(df).collect()}["x"] == 1
    assert drop_null_rows(df, []).count() == 3 and drop_null_rows(df).count() in (1, 2)
    scored = spark.createDataFrame([("a", 7, None), ("a", 9, 3), ("b", 1, None)], "k string, item int, score int")
    assert {r.k: r.item for r in argmax_by_group(scored, "k", "item", "score").collect()} == {"a": 9, "b": 1}
    bins = {r.bin: r["count"] for r in binned_counts(spark.createDataFrame(
        [(v,) for v in (0.0, 0.5, 10.0, float("nan"), None)], "v double"), ["v"], 10).collect()}
    assert bins == {1: 2, 10: 1, None: 2}
