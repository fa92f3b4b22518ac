"""Q13-Q15: trips next to the weather at departure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.clock import WEATHER_DATE_FORMATS, date_of, parse_hour
from ..operators.joins import join_bounded
from ..sources.store import JoinSides, store_join_sides

# Column names of the study's files and answers.
JOIN_KEYS = ("date", "origin", "hour")
WEATHER_MEASURES = ("temp", "wind_dir", "wind_speed", "pressure", "visib")
TRIP_COLUMNS = ("month", "date", "origin", "hour", "flight", "dep_delay", "arr_delay")


def prepare_weather(weather: DataFrame) -> DataFrame:
    """Typed join keys: ``date`` parsed from either date pattern, ``hour``
    from the hour text, whatever of the accepted shapes it has."""
    base = [F.col(c) for c in weather.columns if c not in ("date", "hour")]
    hour = (F.hour("hour_sched_dep") if not isinstance(
        weather.schema["hour_sched_dep"].dataType, StringType) else parse_hour("hour_sched_dep"))
    return weather.select(date_of(weather, "date", WEATHER_DATE_FORMATS).alias("date"),
                          hour.cast("int").alias("hour"), *base)


def join_weather(trips: DataFrame, weather: DataFrame, only_delayed: bool = False,
                 max_weather_rows: int | None = None) -> DataFrame:
    """Q13: inner join of enriched trips and prepared weather on
    (date, origin, hour).

    Unmatched trips are dropped and a repeated weather key repeats the trip
    (check with ``quality.duplicate_keys``).  The weather side is broadcast
    only after its size is checked; a larger one goes to a shuffle join.
    ``only_delayed`` keeps ``arr_delay > 0`` (the Spark notebook); Catalyst
    pushes that filter below the join.
    """
    return join_prepared(trips, prepare_weather(weather), only_delayed, max_weather_rows)


def join_prepared(trips: DataFrame, prepared: DataFrame, only_delayed: bool = False,
                  max_weather_rows: int | None = None) -> DataFrame:
    """:func:`join_weather` with weather whose keys are typed already, such as
    one report per key (``quality.one_per_key``)."""
    w = prepared.select(*JOIN_KEYS, *WEATHER_MEASURES)
    t = trips.select(*TRIP_COLUMNS)
    if only_delayed:
        t = t.where(F.col("arr_delay") > 0)
    j = join_bounded(t, w, list(JOIN_KEYS), "inner", max_weather_rows)
    return j.select(*TRIP_COLUMNS[:5], "dep_delay", "arr_delay", *WEATHER_MEASURES)


def store_weather_join(trips: DataFrame, weather: DataFrame, **params) -> JoinSides:
    """Q13 for repeated use: enriched trips and prepared weather stored once,
    bucketed by (date, origin, hour); see :func:`join_stored_weather`."""
    return store_join_sides(trips.select(*TRIP_COLUMNS), prepare_weather(weather).select(*JOIN_KEYS, *WEATHER_MEASURES),
                            JOIN_KEYS, **params)


def join_stored_weather(sides: JoinSides, only_delayed: bool = False) -> DataFrame:
    """Q13 from stored sides: the same rows as :func:`join_weather`, a merge join
    of buckets without an exchange, however large the weather is."""
    j = sides.joined()
    if only_delayed:
        j = j.where(F.col("arr_delay") > 0)
    return j.select(*TRIP_COLUMNS[:5], "dep_delay", "arr_delay", *WEATHER_MEASURES)


def monthly_weather_delay(joined: DataFrame) -> DataFrame:
    """Q14: per month, mean departure delay and mean of each measure."""
    cols = ("dep_delay",) + WEATHER_MEASURES
    return (joined.groupBy("month")
            .agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])
            .orderBy("month"))


def monthly_weather_delay_scopes(joined: DataFrame) -> DataFrame:
    """Q14 in both notebooks' forms from one pass: per month the means over all
    trips (pandas) and, as ``late_*``, over trips that arrived late (Spark).

    Filtered measures of one aggregate; a month without late trips keeps its row
    with null ``late_*`` means and ``late_trips`` 0."""
    cols = ("dep_delay",) + WEATHER_MEASURES
    late = F.col("arr_delay") > 0
    return (joined.groupBy("month")
            .agg(F.count(F.lit(1)).alias("trips"), *[F.avg(c).alias(f"avg_{c}") for c in cols],
                 F.count_if(late).alias("late_trips"),
                 *[F.avg(F.when(late, F.col(c))).alias(f"late_{c}") for c in cols])
            .orderBy("month"))


def delay_by_wind_speed(joined: DataFrame) -> DataFrame:
    """Q15: mean arrival delay per wind speed."""
    return (joined.groupBy("wind_speed").agg(F.avg("arr_delay").alias("avg_arr_delay"))
            .orderBy("wind_speed"))


_SCOPES = ("all", "late")


def hourly_weather(trips: DataFrame, weather: DataFrame, max_weather_rows: int | None = None) -> DataFrame:
    """One row per (date, origin, hour) that has trips and weather: the weather
    measures, and per scope (all trips, trips that arrived late) the number of
    trips and the sum and count of each delay.

    The trips are summed first (a partial + final aggregate, filtered measures for
    the late ones), so one row per hour and airport meets the weather, and every
    mean of both notebooks follows from this small table."""
    late = F.col("arr_delay") > 0
    sums = []
    for scope in _SCOPES:
        def of(c, scope=scope):
            return F.when(late, c) if scope == "late" else c
        sums += [F.count(of(F.lit(1))).alias(f"{scope}_n"),
                 *[f(of(F.col(c))).alias(f"{scope}_{name}_{c}") for c in ("dep_delay", "arr_delay")
                   for name, f in (("sum", F.sum), ("count", F.count))]]
    w = prepare_weather(weather).select(*JOIN_KEYS, *WEATHER_MEASURES)
    return join_bounded(trips.groupBy(*JOIN_KEYS).agg(*sums), w, list(JOIN_KEYS), "inner", max_weather_rows)


def _scope(hours: DataFrame, only_delayed: bool) -> tuple[DataFrame, str]:
    scope = _SCOPES[only_delayed]
    return hours.where(F.col(f"{scope}_n") > 0), scope


def _mean_delay(scope: str, col: str) -> Column:
    return F.sum(f"{scope}_sum_{col}") / F.sum(f"{scope}_count_{col}")


def _mean_measure(scope: str, col: str) -> Column:
    """Mean of a weather measure over the trips of each hour: weighted by the
    hour's trip count, over the hours where the measure is known."""
    m, n = F.col(col), F.col(f"{scope}_n")
    return F.sum(m * n) / F.sum(F.when(m.isNotNull(), n))


def monthly_from_hours(hours: DataFrame, only_delayed: bool = False) -> DataFrame:
    """Q14 from :func:`hourly_weather`: the join key fixes the month."""
    rows, scope = _scope(hours, only_delayed)
    return (rows.groupBy(F.month("date").alias("month"))
            .agg(_mean_delay(scope, "dep_delay").alias("avg_dep_delay"),
                 *[_mean_measure(scope, c).alias(f"avg_{c}") for c in WEATHER_MEASURES])
            .orderBy("month"))


def wind_speed_from_hours(hours: DataFrame, only_delayed: bool = True) -> DataFrame:
    """Q15 from :func:`hourly_weather`."""
    rows, scope = _scope(hours, only_delayed)
    return rows.groupBy("wind_speed").agg(_mean_delay(scope, "arr_delay").alias("avg_arr_delay")).orderBy("wind_speed")


def monthly_weather_delay_from(trips: DataFrame, weather: DataFrame,
                               only_delayed: bool = False,
                               max_weather_rows: int | None = None) -> DataFrame:
    """Q14 without the row-level join: the same means as
    ``monthly_weather_delay(join_weather(trips, weather))``."""
    return monthly_from_hours(hourly_weather(trips, weather, max_weather_rows), only_delayed)


def delay_by_wind_speed_from(trips: DataFrame, weather: DataFrame, only_delayed: bool = True,
                             max_weather_rows: int | None = None) -> DataFrame:
    """Q15 without the row-level join (see :func:`hourly_weather`); by default
    over trips that arrived late, as the Spark notebook."""
    return wind_speed_from_hours(hourly_weather(trips, weather, max_weather_rows), only_delayed)
