"""Q10-Q12, Q19: delayed share, least / most delayed airports, delay by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count_by, filtered_share, top_n


def _delayed(trips: DataFrame) -> DataFrame:
    """C4: trips that left late (``dep_delay > 0``)."""
    return trips.where(F.col("dep_delay") > 0)


def delayed_share(trips: DataFrame, origin) -> DataFrame:
    """Q10: total, delayed and delayed_pct for one origin, in one pass.
    No trips from ``origin`` gives total 0 and a null share."""
    return filtered_share(trips, F.col("origin") == F.lit(origin), F.col("dep_delay") > 0)


def least_delayed_origin(trips: DataFrame, k: int = 1) -> DataFrame:
    """Q11: origin(s) with the fewest delayed departures -> origin, count."""
    return top_n(count_by(_delayed(trips), ["origin"]), "count", ["origin"], k, ascending=True)


def most_delayed_dest(trips: DataFrame, k: int = 1) -> DataFrame:
    """Q12: destination(s) with the most delayed departures -> dest, count."""
    return top_n(count_by(_delayed(trips), ["dest"]), "count", ["dest"], k)


def delay_by_hour(trips: DataFrame) -> DataFrame:
    """Q19: mean departure delay per scheduled hour, over trips late both
    leaving and arriving -> hour, avg_delay."""
    late = trips.where((F.col("dep_delay") > 0) & (F.col("arr_delay") > 0))
    return late.groupBy("hour").agg(F.avg("dep_delay").alias("avg_delay")).orderBy("hour")
