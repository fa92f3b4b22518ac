"""Q1-Q3: cleaning the flights, weather and planes tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.quality import drop_null_rows, drop_sparse_columns, fill_group_mean
from ..sources.schemas import FLIGHT_REQUIRED_COLUMNS, WEATHER_FILL_COLUMNS

#: The group a missing ``air_time`` is filled from.
ROUTE_KEYS = ("carrier", "origin", "dest")
#: The group a missing weather measure is filled from.
WEATHER_KEYS = ("origin", "date")


def clean_flights(df: DataFrame, required: Sequence[str] = FLIGHT_REQUIRED_COLUMNS,
                  fill_cols: Sequence[str] = ("air_time",),
                  keys: Sequence[str] = ROUTE_KEYS) -> DataFrame:
    """Q1: drop trips that did not fly, then fill ``air_time`` with the mean
    of its (carrier, origin, dest) group.  Order matters: the means are taken
    after the drop, as in the study."""
    kept = drop_null_rows(df, required)
    return fill_group_mean(kept, keys, fill_cols)


def clean_weather(df: DataFrame, cols: Sequence[str] = WEATHER_FILL_COLUMNS,
                  keys: Sequence[str] = WEATHER_KEYS) -> DataFrame:
    """Q2: fill each measure with its (origin, date) daily mean.  The pandas
    notebook filled ``temp`` only; pass ``cols=('temp',)`` for that."""
    return fill_group_mean(df, keys, cols)


def clean_planes(df: DataFrame, threshold_pct: float = 70.0) -> DataFrame:
    """Q3: drop columns more than ``threshold_pct`` % empty, then rows with
    any gap."""
    return drop_null_rows(drop_sparse_columns(df, threshold_pct))
