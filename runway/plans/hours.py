"""Q8/Q9: busiest hour of the day per carrier or per origin."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregates import argmax_by_group, columnwise_max, count_by


def hourly_counts(trips: DataFrame, by: str) -> DataFrame:
    """By, hour, count."""
    return count_by(trips, [by, "hour"], "count")


def busiest_hour(trips: DataFrame, by: str = "carrier", mode: str = "argmax") -> DataFrame:
    """Q8 (``by='carrier'``) / Q9 (``by='origin'``).

    ``mode='argmax'`` answers the question: per group, the hour with most
    departures (earliest hour on ties) -> by, hour, count.
    ``mode='columnwise'`` reproduces the notebooks' ``groupby(by).max()``:
    the largest hour and the largest count, independently -> by, max_hour,
    max_count.
    """
    counts = hourly_counts(trips, by)
    if mode == "argmax":
        return argmax_by_group(counts, by, "hour", "count").orderBy(by)
    if mode == "columnwise":
        return columnwise_max(counts, by, ["hour", "count"]).orderBy(by)
    raise ValueError(f"mode must be 'argmax' or 'columnwise', not {mode!r}")
