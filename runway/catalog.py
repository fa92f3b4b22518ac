"""Registered queries: one per operator group of the study.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the whole driver tables (through ``sources.roles``).  Doubles that
come out of averages are rounded to 4 places here, not in the library,
so the DuckDB oracle (``runway.oracle``) can match them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .functions.clock import hhmm_minutes, hhmm_minutes_text
from .operators.joins import materialize
from .operators.means import (fill_from_state, load_state, mean_state, merged_states, save_state,
                              without_state)
from .operators.quality import (column_profile, distinct_values, drop_null_rows,
                                drop_columns, drop_sparse_columns, duplicate_keys, fill_group_mean,
                                fill_mean, frame_difference, group_mean, null_counts, null_pct,
                                one_per_key, preview, sentinel_counts)
from .plans.cleaning import ROUTE_KEYS, clean_flights, clean_planes, clean_weather
from .plans.delays import (delay_by_hour, delayed_share, least_delayed_origin,
                           most_delayed_dest)
from .plans.enrich import enrich_flights
from .plans.fleet import (fuel_by_each_trait, fuel_by_plane_traits, fuel_by_trait,
                          fuel_by_year)
from .plans.hours import busiest_hour
from .plans.routes import (busiest_routes, busiest_routes_sql, carrier_route_vs_total,
                           carrier_totals, carriers_on_top_routes)
from .plans.series import binned_counts, chart_series, pairwise_corr
from .plans.weather import (JOIN_KEYS, delay_by_wind_speed, delay_by_wind_speed_from, join_prepared,
                            join_stored_weather, join_weather, monthly_weather_delay,
                            monthly_weather_delay_from, monthly_weather_delay_scopes, prepare_weather,
                            store_weather_join)
from .session import scratch_path
from .sources import roles
from .sources.csv import read_csv_checked, read_flights, write_table
from .sources.schemas import FLIGHT_REQUIRED_COLUMNS, FLIGHTS

Query = Callable[[SparkSession, str], DataFrame]

#: Parameters of the registered queries (fixed values of this catalogue).
TOP_K = 5
ONE_YEAR = 1997
ONE_DAY = "1/3/2024"
CLOCK_COLUMNS = ("sched_dep_time", "dep_time", "sched_arr_time", "arr_time")
MONTHS = 12
SHARE_ORIGIN_TRIPS = 0
SHARE_ORIGIN_FLIGHTS = "1"
PAIR_COLUMNS = ("engines", "seats", "avg_fuel_cc")
BINS = 10


def r4(df: DataFrame) -> DataFrame:
    """Round every double column to 4 places (comparison form)."""
    return df.select([F.round(F.col(f.name), 4).alias(f.name)
                      if isinstance(f.dataType, DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


# -- roles and derived tables --------------------------------------------------

def trips(spark, d):
    return roles.trips(spark, d)


def raw_flights(spark, d, months=1):
    return roles.clock_trips(spark, d, months)


def flights(spark, d, shift_seconds=1, round_result=False, months=1, fill_cols=("air_time",)):
    """Cleaned and enriched flights (the study's working table)."""
    return enrich_flights(clean_flights(raw_flights(spark, d, months), fill_cols=fill_cols),
                          shift_seconds=shift_seconds, round_result=round_result)


def flown(spark, d, shift_seconds=1, round_result=False, months=1):
    """The same flights for questions that do not ask for ``air_time``: its gaps
    stay, so neither its means nor a join with them is computed."""
    return flights(spark, d, shift_seconds, round_result, months, fill_cols=())


def raw_weather(spark, d):
    return roles.weather(spark, d)


def weather(spark, d, months=1):
    """Filled weather; the raw table is an aggregate read twice (means, rows), so
    it is computed once."""
    return clean_weather(materialize(roles.weather(spark, d, months)))


def joined(spark, d, only_delayed=False, months=1):
    return join_weather(flown(spark, d, months=months), weather(spark, d, months), only_delayed=only_delayed)


def joined_stored(spark, d, only_delayed=False):
    """D5 from sides stored bucketed by the join keys."""
    return join_stored_weather(store_weather_join(flown(spark, d), weather(spark, d)), only_delayed)


def reports_prepared(spark, d):
    return prepare_weather(roles.weather_reports(spark, d))


def one_report_per_hour(spark, d):
    """The latest report of each hour and airport."""
    return one_per_key(reports_prepared(spark, d), JOIN_KEYS, [F.col("reported")])


def raw_planes(spark, d):
    return roles.fleet(spark, d)


def planes(spark, d):
    return clean_planes(raw_planes(spark, d))


def csv_roundtrip(spark, d):
    """A1+A2: write the flights file as CSV (gaps as ``NA``) under the shared
    folder and read it back with the declared schema."""
    path = scratch_path(spark, "flights-csv")
    write_table(raw_flights(spark, d), path, "csv", null_value="NA")
    return read_flights(spark, path)


def _csv_with_bad_cells(spark, d):
    """A flights file in which some clocks and air times are no numbers."""
    f = raw_flights(spark, d)
    return f.select(*[
        F.when(F.col("flight") % 29 == 0, F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c) if c == "dep_time"
        else F.when(F.col("flight") % 43 == 0, F.lit("12:30")).otherwise(F.col(c).cast("string")).alias(c)
        if c == "sched_arr_time" else F.col(c) for c in f.columns])


def csv_checked(spark, d):
    """A1: (rows, rejects) of a file with bad cells, from one pass."""
    path = scratch_path(spark, "flights-csv")
    write_table(_csv_with_bad_cells(spark, d), path, "csv", null_value="NA")
    return read_csv_checked(spark, path, FLIGHTS)


def _csv_rejects(spark, d):
    """Without the file's name, which is the run's own, and the last cell, a
    double as text."""
    rejects = csv_checked(spark, d)[1]
    return rejects.select(F.substring_index("row_text", ",", 10).alias("row_text"), "column", "cell")


def _daily_states(spark, d):
    """B7 by parts: each day's state on its own, merged, and used for the fill.
    A day that is saved again replaces itself."""
    f = drop_null_rows(raw_flights(spark, d), FLIGHT_REQUIRED_COLUMNS)
    path = scratch_path(spark, "mean-states")
    per_day = materialize(mean_state(f, ("date", *ROUTE_KEYS), ["air_time"]))
    for half, days in (("first", F.col("date") < "1/2"), ("second", F.col("date") >= "1/2"), ("first", F.col("date") < "1/2")):
        save_state(merged_states([per_day.where(days).drop("date")], ROUTE_KEYS), path, half)
    return fill_from_state(f, load_state(spark, path, ROUTE_KEYS), ROUTE_KEYS, ["air_time"])


def _without_a_part(spark, d):
    """D1 by subtraction: the means of all days without one of them."""
    f = drop_null_rows(raw_flights(spark, d), FLIGHT_REQUIRED_COLUMNS)
    per_day = materialize(mean_state(f, ("date", *ROUTE_KEYS), ["air_time"]))
    whole = merged_states([per_day.drop("date")], ROUTE_KEYS)
    rest = without_state(whole, per_day.where(F.col("date") == ONE_DAY).drop("date"), ROUTE_KEYS)
    return rest.select(*ROUTE_KEYS, F.try_divide("sum_air_time", "n_air_time").alias("mean_air_time"),
                       F.col("n_air_time").alias("n"))


def _cleaning_difference(spark, d):
    """What cleaning changed, as rows of either side."""
    raw = materialize(raw_flights(spark, d))
    return frame_difference(r4(raw), r4(clean_flights(raw)))


def csv_reordered(spark, d):
    """A1: a file whose columns stand in another order, with one more and with
    clocks written as ``517.0``, read by its header."""
    f = raw_flights(spark, d)
    clocks = ("sched_dep_time", "dep_time", "sched_arr_time", "arr_time")
    path = scratch_path(spark, "flights-csv")
    out = f.select(F.lit("x").alias("extra"), *[F.col(c).cast("double").cast("string").alias(c) if c in clocks else F.col(c)
                                                for c in reversed(f.columns)])
    write_table(out, path, "csv", null_value="NA")
    return read_flights(spark, path)


def joined_csv_roundtrip(spark, d):
    """A2 as in the pandas notebook: the weather join written as CSV (a folder
    of parts under the shared folder), read back with its own schema."""
    j = r4(joined(spark, d))
    path = scratch_path(spark, "weather-flight-csv")
    write_table(j, path, "csv")
    return spark.read.schema(j.schema).option("header", True).csv(path)


def _clock_text(spark, d):
    f = raw_flights(spark, d)
    return f.select(
        "flight", "sched_dep_time", "dep_time",
        hhmm_minutes("sched_dep_time").alias("sched_dep_min"),
        hhmm_minutes_text(F.col("sched_dep_time").cast("string")).alias("sched_dep_min_text"),
        hhmm_minutes("dep_time").alias("dep_min"),
        hhmm_minutes_text(F.col("dep_time").cast("string")).alias("dep_min_text"))


def _day_of_month(spark, d):
    return flown(spark, d).select("flight", "date", F.dayofmonth("date").alias("day_of_month"),
                                    "day")


def _spot_check(spark, d):
    """The study's five-term lookup of one trip (here a carrier/route/hour)."""
    f = flights(spark, d)
    cond = ((F.col("carrier") == "purchase") & (F.col("origin") == "2") & (F.col("dest") == "4")
            & (F.col("hour") == 17) & F.col("tailnum").isNotNull())
    return r4(f.where(cond).select("date", "sched_dep_time", "dep_time", "carrier", "origin",
                                   "dest", "air_time", "flight"))


def _distinct_weather(spark, d):
    w = weather(spark, d)
    return r4(distinct_values(w, (F.col("origin") == "0") & (F.col("wind_speed") == 3.0),
                              ["origin", "pressure", "humid", "wind_dir"]))


QUERIES: dict[str, Query] = {
    # trips role: routes and delayed airports
    "busiest_route": lambda s, d: busiest_routes(trips(s, d), 1),
    "top5_routes": lambda s, d: busiest_routes(trips(s, d), TOP_K),
    "busiest_route_one_year": lambda s, d: busiest_routes(trips(s, d), 1, year=ONE_YEAR),
    "top5_routes_sql": lambda s, d: busiest_routes_sql(trips(s, d), TOP_K),
    "carriers_on_top_routes": lambda s, d: carriers_on_top_routes(trips(s, d), TOP_K),
    "carriers_on_top_routes_of_year": lambda s, d: carriers_on_top_routes(trips(s, d), TOP_K, rank_year=ONE_YEAR),
    "carrier_route_vs_total_of_year": lambda s, d: carrier_route_vs_total(trips(s, d), TOP_K, rank_year=ONE_YEAR),
    "carrier_totals": lambda s, d: carrier_totals(trips(s, d)),
    "carrier_route_vs_total": lambda s, d: carrier_route_vs_total(trips(s, d), TOP_K),
    "least_delayed_origin": lambda s, d: least_delayed_origin(trips(s, d)),
    "most_delayed_dest": lambda s, d: most_delayed_dest(trips(s, d)),
    "delayed_share_trips": lambda s, d: r4(delayed_share(trips(s, d), SHARE_ORIGIN_TRIPS)),
    # flights role: cleaning, clocks, hours, delays
    "null_counts": lambda s, d: null_counts(raw_flights(s, d)),
    "column_profile": lambda s, d: column_profile(raw_flights(s, d)),
    "preview": lambda s, d: r4(preview(raw_flights(s, d).orderBy("flight"))),
    "drop_named_columns": lambda s, d: r4(drop_columns(flights(s, d), CLOCK_COLUMNS)),
    "drop_null_rows_subset": lambda s, d: r4(drop_null_rows(raw_flights(s, d),
                                                            FLIGHT_REQUIRED_COLUMNS)),
    "fill_group_mean": lambda s, d: r4(fill_group_mean(raw_flights(s, d), ROUTE_KEYS,
                                                       ["air_time"])),
    "group_mean_kept_on_rows": lambda s, d: r4(group_mean(raw_flights(s, d), ROUTE_KEYS,
                                                          "air_time")),
    "fill_mean": lambda s, d: r4(fill_mean(raw_flights(s, d), ["air_time"])),
    "clean_flights": lambda s, d: r4(clean_flights(raw_flights(s, d))),
    "enrich_flights": lambda s, d: r4(flights(s, d)),
    "enrich_flights_minute_shift": lambda s, d: r4(flights(s, d, 60, True)),
    "clock_text_decode": _clock_text,
    "day_of_month": _day_of_month,
    "spot_check_filter": _spot_check,
    "busiest_hour_by_carrier": lambda s, d: busiest_hour(flown(s, d), "carrier"),
    "busiest_hour_by_carrier_columnwise":
        lambda s, d: busiest_hour(flown(s, d), "carrier", "columnwise"),
    "busiest_hour_by_origin": lambda s, d: busiest_hour(flown(s, d), "origin"),
    "busiest_hour_by_origin_columnwise":
        lambda s, d: busiest_hour(flown(s, d), "origin", "columnwise"),
    "delayed_share": lambda s, d: r4(delayed_share(flown(s, d), SHARE_ORIGIN_FLIGHTS)),
    "delayed_share_minute_shift":
        lambda s, d: r4(delayed_share(flown(s, d, 60, True), SHARE_ORIGIN_FLIGHTS)),
    "least_delayed_origin_flights": lambda s, d: least_delayed_origin(flown(s, d)),
    "most_delayed_dest_flights": lambda s, d: most_delayed_dest(flown(s, d)),
    "delay_by_hour": lambda s, d: r4(delay_by_hour(flown(s, d))),
    "csv_roundtrip": csv_roundtrip,
    "csv_reordered": csv_reordered,
    "csv_checked_rows": lambda s, d: r4(csv_checked(s, d)[0]),
    "csv_rejects": _csv_rejects,
    "fill_group_mean_from_states": lambda s, d: r4(_daily_states(s, d)),
    "group_mean_without_a_day": lambda s, d: r4(_without_a_part(s, d)),
    "cleaning_difference": _cleaning_difference,
    # weather role
    "sentinel_counts": lambda s, d: sentinel_counts(roles.weather_text(raw_weather(s, d)), "NA"),
    "null_counts_weather": lambda s, d: null_counts(raw_weather(s, d)),
    "fill_weather_daily_mean": lambda s, d: r4(weather(s, d)),
    "fill_weather_temp_only": lambda s, d: r4(clean_weather(raw_weather(s, d), cols=("temp",))),
    "distinct_values": _distinct_weather,
    "weather_duplicate_keys": lambda s, d: duplicate_keys(reports_prepared(s, d), JOIN_KEYS),
    "weather_latest_report": lambda s, d: r4(one_report_per_hour(s, d)),
    "join_weather_reports": lambda s, d: r4(join_weather(flown(s, d), roles.weather_reports(s, d))),
    "join_weather_latest_report": lambda s, d: r4(join_prepared(flown(s, d), one_report_per_hour(s, d))),
    "join_weather_stored": lambda s, d: r4(joined_stored(s, d)),
    "join_weather": lambda s, d: r4(joined(s, d)),
    "join_weather_delayed_only": lambda s, d: r4(joined(s, d, only_delayed=True)),
    "join_weather_csv_roundtrip": joined_csv_roundtrip,
    "monthly_weather_delay": lambda s, d: r4(monthly_weather_delay(joined(s, d))),
    "delay_by_wind_speed": lambda s, d: r4(delay_by_wind_speed(joined(s, d, only_delayed=True))),
    "monthly_weather_delay_year": lambda s, d: r4(monthly_weather_delay(joined(s, d, months=MONTHS))),
    "monthly_weather_delay_late": lambda s, d: r4(monthly_weather_delay(joined(s, d, True, MONTHS))),
    "monthly_weather_delay_scopes": lambda s, d: r4(monthly_weather_delay_scopes(joined(s, d, months=MONTHS))),
    "monthly_weather_delay_preaggregated":
        lambda s, d: r4(monthly_weather_delay_from(flown(s, d), weather(s, d))),
    "delay_by_wind_speed_preaggregated":
        lambda s, d: r4(delay_by_wind_speed_from(flown(s, d), weather(s, d))),
    # fleet role
    "null_counts_planes": lambda s, d: null_counts(raw_planes(s, d)),
    "null_pct": lambda s, d: r4(null_pct(raw_planes(s, d))),
    "drop_sparse_columns": lambda s, d: drop_sparse_columns(raw_planes(s, d)),
    "drop_null_rows_any": lambda s, d: drop_null_rows(raw_planes(s, d)),
    "clean_planes": lambda s, d: planes(s, d),
    "fuel_by_year": lambda s, d: r4(fuel_by_year(planes(s, d))),
    "fuel_by_plane_traits": lambda s, d: r4(fuel_by_plane_traits(planes(s, d))),
    "fuel_by_type": lambda s, d: r4(fuel_by_trait(planes(s, d), "type")),
    "fuel_by_engines": lambda s, d: r4(fuel_by_trait(planes(s, d), "engines")),
    "fuel_by_seats": lambda s, d: r4(fuel_by_trait(planes(s, d), "seats")),
    "fuel_by_engine": lambda s, d: r4(fuel_by_trait(planes(s, d), "engine")),
    "fuel_by_each_trait": lambda s, d: r4(fuel_by_each_trait(planes(s, d))),
    "chart_series": lambda s, d: r4(chart_series(fuel_by_year(planes(s, d)),
                                                 "manufacturing_year", "avg_fuel_cc")),
    "pairwise_corr": lambda s, d: r4(pairwise_corr(fuel_by_plane_traits(planes(s, d)),
                                                   PAIR_COLUMNS)),
    "binned_counts": lambda s, d: binned_counts(fuel_by_plane_traits(planes(s, d)),
                                                PAIR_COLUMNS, BINS),
}
