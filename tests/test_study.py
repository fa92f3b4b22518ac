"""The one-call study equals the separately registered analyses."""

from runway import catalog
from runway.operators.quality import frames_equal
from runway.plans.study import run_study
from runway.session import scratch_path

from conftest import SF_SMALL


def test_study_matches_registered_queries(spark):
    q = catalog.QUERIES
    ans = run_study(catalog.raw_flights(spark, SF_SMALL), catalog.raw_weather(spark, SF_SMALL),
                    catalog.raw_planes(spark, SF_SMALL), origin=catalog.SHARE_ORIGIN_FLIGHTS,
                    out_dir=scratch_path(spark, "study-out"))
    assert frames_equal(ans["busiest_hour_by_carrier"], q["busiest_hour_by_carrier"](spark, SF_SMALL))
    assert frames_equal(catalog.r4(ans["delayed_share"]), q["delayed_share"](spark, SF_SMALL))
    assert frames_equal(catalog.r4(ans["delay_by_hour"]), q["delay_by_hour"](spark, SF_SMALL))
    assert frames_equal(catalog.r4(ans["monthly_weather_delay"]),
                        q["monthly_weather_delay"](spark, SF_SMALL))
    assert frames_equal(catalog.r4(ans["fuel_by_year"]), q["fuel_by_year"](spark, SF_SMALL))
    assert frames_equal(ans["most_delayed_dest"], q["most_delayed_dest_flights"](spark, SF_SMALL))
    assert frames_equal(catalog.r4(ans["delay_by_wind_speed"]), q["delay_by_wind_speed"](spark, SF_SMALL))
    late = catalog.monthly_weather_delay(catalog.joined(spark, SF_SMALL, only_delayed=True))
    assert frames_equal(catalog.r4(ans["monthly_weather_delay_late"]), catalog.r4(late))
    assert len(ans) == 17


def test_command_line_study(spark):
    from runway.__main__ import main
    from runway.sources.csv import write_table
    src = scratch_path(spark, "study-csv")
    write_table(catalog.raw_flights(spark, SF_SMALL), f"{src}/flights", null_value="NA")
    write_table(catalog.raw_weather(spark, SF_SMALL), f"{src}/weather", null_value="NA")
    write_table(catalog.raw_planes(spark, SF_SMALL), f"{src}/planes", null_value="NA")
    out = scratch_path(spark, "study-answers")
    main(["--flights", f"{src}/flights", "--weather", f"{src}/weather", "--planes",
          f"{src}/planes", "--origin", "1", "--out", out])
    got = spark.read.parquet(f"{out}/busiest_hour_by_carrier")
    assert frames_equal(got, catalog.QUERIES["busiest_hour_by_carrier"](spark, SF_SMALL))
    share = spark.read.parquet(f"{out}/delayed_share")
    assert frames_equal(catalog.r4(share), catalog.QUERIES["delayed_share"](spark, SF_SMALL))


def test_study_writes_csv_answers(spark):
    out = scratch_path(spark, "study-csv-out")
    ans = run_study(catalog.raw_flights(spark, SF_SMALL), catalog.raw_weather(spark, SF_SMALL),
                    catalog.raw_planes(spark, SF_SMALL), origin="0", out_dir=out,
                    out_format="csv")
    back = spark.read.option("header", True).schema(ans["carrier_totals"].schema) \
        .csv(f"{out}/carrier_totals")
    assert frames_equal(back, ans["carrier_totals"])


def test_hourly_weather_of_months_without_late_trips(spark):
    """Both scopes from the hourly table equal the row-level join's, gaps included."""
    from pyspark.sql import functions as F

    from runway.plans.weather import (delay_by_wind_speed, hourly_weather, join_weather, monthly_from_hours,
                                      monthly_weather_delay, wind_speed_from_hours)
    trips = catalog.flights(spark, SF_SMALL, months=4).withColumn(
        "arr_delay", F.when(F.col("month") == 2, F.lit(-1.0)).when(F.col("flight") % 5 > 0, F.col("arr_delay")))
    wx = catalog.weather(spark, SF_SMALL, 4)
    hours = hourly_weather(trips, wx)
    for late in (False, True):
        rows = join_weather(trips, wx, only_delayed=late)
        assert frames_equal(catalog.r4(monthly_from_hours(hours, late)), catalog.r4(monthly_weather_delay(rows)))
        assert frames_equal(catalog.r4(wind_speed_from_hours(hours, late)), catalog.r4(delay_by_wind_speed(rows)))
    assert {r["month"] for r in monthly_from_hours(hours, True).collect()} == {1, 3, 4}


def test_command_line_with_rejects(spark):
    from pyspark.sql import functions as F

    from runway.__main__ import main
    from runway.sources.csv import write_table
    src, out, bad = (scratch_path(spark, f"study-{n}") for n in ("bad-csv", "bad-answers", "rejects"))
    raw = catalog.raw_flights(spark, SF_SMALL)
    text = raw.withColumn("dep_time", F.when(F.col("flight") % 9 == 0, F.lit("late")).otherwise(F.col("dep_time").cast("string")))
    write_table(text, f"{src}/flights", null_value="NA")
    write_table(catalog.raw_weather(spark, SF_SMALL), f"{src}/weather", null_value="NA")
    write_table(catalog.raw_planes(spark, SF_SMALL), f"{src}/planes", null_value="NA")
    main(["--flights", f"{src}/flights", "--weather", f"{src}/weather", "--planes", f"{src}/planes", "--origin", "1",
          "--out", out, "--rejects", bad, "--rank-year", "2024"])
    rejects = spark.read.parquet(f"{bad}/flights")
    assert rejects.count() == raw.where("flight % 9 = 0").count() and {r["cell"] for r in rejects.collect()} == {"late"}
    assert spark.read.parquet(f"{bad}/weather").count() == 0
    kept = catalog.carrier_totals(catalog.enrich_flights(catalog.clean_flights(raw.where("flight % 9 <> 0"))))
    assert frames_equal(spark.read.parquet(f"{out}/carrier_totals"), kept)
