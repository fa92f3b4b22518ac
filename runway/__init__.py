"""runway: flight-operations analytics as Spark DataFrame functions.

Sub-packages:

* ``sources``   typed CSV/Parquet scans and sinks, driver-table role adapters
* ``functions`` Column builders (dates, HHMM clocks, delays)
* ``operators`` reusable DataFrame operators (quality, aggregates, joins)
* ``plans``     the named analyses (cleaning, routes, hours, delays, ...)
* ``streaming`` the same analyses over a stream of trip files
"""

from .functions.clock import (clock_timestamp, delay_minutes, hhmm_minutes,
                              hhmm_minutes_text, parse_date, parse_hour, weekday_name)
from .operators.aggregates import (argmax_by_group, columnwise_max, count_by,
                                   filtered_share, mean_by, top_n, top_n_sql)
from .functions.dictionary import decoded
from .operators.joins import join_bounded, join_top_k
from .operators.means import (fill_from_state, load_state, mean_state, merged_states, save_state,
                              without_state)
from .operators.quality import (column_profile, distinct_values, drop_columns, drop_null_rows,
                                drop_sparse_columns, duplicate_keys, fill_group_mean,
                                fill_mean, frame_difference, frames_equal, group_mean, null_counts,
                                null_pct, one_per_key, preview, sentinel_counts, sparse_columns)
from .plans.cleaning import clean_flights, clean_planes, clean_weather
from .plans.delays import (delay_by_hour, delayed_share, least_delayed_origin,
                           most_delayed_dest)
from .plans.enrich import enrich_flights
from .plans.fleet import (fuel_by_each_trait, fuel_by_plane_traits, fuel_by_trait,
                          fuel_by_year)
from .plans.hours import busiest_hour, hourly_counts
from .plans.routes import (busiest_routes, busiest_routes_sql, carrier_route_vs_total,
                           carrier_totals,
                           carriers_on_top_routes, route_carrier_counts, route_counts)
from .plans.series import binned_counts, chart_series, pairwise_corr, pairwise_series
from .plans.study import run_study
from .plans.weather import (delay_by_wind_speed, delay_by_wind_speed_from, hourly_weather,
                            join_stored_weather, join_weather, monthly_weather_delay,
                            monthly_weather_delay_from, monthly_weather_delay_scopes, prepare_weather,
                            store_weather_join)
from .sources.csv import read_csv_checked
from .sources.store import store_join_sides

__version__ = "0.1.0"
