"""The whole study in one call: every answer from the three raw tables.

The notebooks re-read and re-cleaned their inputs for every action.  Here
the cleaned, enriched flights are written once as Parquet partitioned by
(year, month) under a work folder (by default in the shared checkpoint
folder), cleaned weather and planes are checkpointed, and every answer is a
lazy DataFrame over those stored tables: columnar, pruned, never recomputed
from the raw input.  The weather answers sum the trips per (date, origin,
hour) before they meet the weather, so no row-level join is built; all three
read that one hourly table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import materialize
from ..session import scratch_path
from ..sources.csv import write_table
from ..sources.store import load_stored, store_partitioned
from .cleaning import clean_flights, clean_planes, clean_weather
from .delays import delay_by_hour, delayed_share, least_delayed_origin, most_delayed_dest
from .enrich import enrich_flights
from .fleet import fuel_by_each_trait, fuel_by_plane_traits, fuel_by_year
from .hours import busiest_hour
from .routes import busiest_routes, carrier_route_vs_total, carrier_totals, carriers_on_top_routes
from .weather import hourly_weather, monthly_from_hours, wind_speed_from_hours


def run_study(flights: DataFrame, weather: DataFrame, planes: DataFrame, origin,
              k: int = 5, shift_seconds: int = 1, work_dir: str | None = None,
              out_dir: str | None = None, out_format: str = "parquet",
              rank_year: int | None = None) -> dict[str, DataFrame]:
    """Return every answer of the study by name; write them to ``out_dir``
    (one folder each) when given.

    ``flights``, ``weather`` and ``planes`` are the raw tables (see
    ``sources.csv.read_*``); ``origin`` is the airport of the delayed-share
    question; ``rank_year`` ranks the routes by the trips of one year and counts
    those of all, as the Spark notebook does.
    """
    spark = flights.sparkSession
    work = work_dir or scratch_path(spark, "study")
    store_partitioned(enrich_flights(clean_flights(flights), shift_seconds=shift_seconds),
                      f"{work}/flights")
    trips = load_stored(spark, f"{work}/flights")
    wx = materialize(clean_weather(materialize(weather)))
    fleet = materialize(clean_planes(planes))
    hours = materialize(hourly_weather(trips, wx))
    answers = {
        "busiest_route": busiest_routes(trips, 1),
        "top_routes": busiest_routes(trips, k),
        "carriers_on_top_routes": carriers_on_top_routes(trips, k, rank_year=rank_year),
        "carrier_totals": carrier_totals(trips),
        "carrier_route_vs_total": carrier_route_vs_total(trips, k, rank_year=rank_year),
        "busiest_hour_by_carrier": busiest_hour(trips, "carrier"),
        "busiest_hour_by_origin": busiest_hour(trips, "origin"),
        "delayed_share": delayed_share(trips, origin),
        "least_delayed_origin": least_delayed_origin(trips),
        "most_delayed_dest": most_delayed_dest(trips),
        "monthly_weather_delay": monthly_from_hours(hours),
        "monthly_weather_delay_late": monthly_from_hours(hours, only_delayed=True),
        "delay_by_wind_speed": wind_speed_from_hours(hours),
        "fuel_by_year": fuel_by_year(fleet),
        "fuel_by_plane_traits": fuel_by_plane_traits(fleet),
        "fuel_by_each_trait": fuel_by_each_trait(fleet),
        "delay_by_hour": delay_by_hour(trips),
    }
    if out_dir:
        for name, df in answers.items():
            write_table(df, f"{out_dir}/{name}", out_format)
    return answers
