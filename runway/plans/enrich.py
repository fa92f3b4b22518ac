"""Q4: dates, clocks and delays for the flights table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from ..functions.clock import (FLIGHT_DATE_FORMATS, clock_timestamp, date_of, delay_from_minutes,
                               minutes_of, parse_date, weekday_name)
from ..functions.dictionary import decoded


def enrich_flights(df: DataFrame, shift_seconds: int = 1, wrap: str | None = None,
                   round_result: bool = False,
                   date_formats: Sequence[str] = FLIGHT_DATE_FORMATS) -> DataFrame:
    """Add year, month, weekday (``day``), four clock timestamps, both delays
    and the scheduled hour; ``date`` becomes a DateType column.

    ``shift_seconds`` moves the actual clocks back: 1 (pandas notebook, so
    ``dep_delay > 0`` means at least one minute late) or 60 (Spark notebook,
    at least two minutes).  One ``select``: a single projection, no stack
    of per-column rewrites.  ``date`` may arrive as text (parsed with
    ``date_formats``), a date or a timestamp; clocks as integers or text.

    Date texts are decoded through a dictionary (a job when this is called): a
    year of flights has 365 of them, and a filter on a delay below a join does
    not parse them again.  In a stream, whose texts are not all known, each row's
    date is parsed.
    """
    if isinstance(df.schema["date"].dataType, StringType) and not df.isStreaming:
        df = decoded(df, "date", lambda text: parse_date(text, date_formats))
    d = date_of(df, "date", date_formats)
    sd, dm = minutes_of(df, "sched_dep_time"), minutes_of(df, "dep_time")
    sa, am = minutes_of(df, "sched_arr_time"), minutes_of(df, "arr_time")
    known = d.isNotNull()
    base = [F.col(c) for c in df.columns if c != "date"]
    # Delays and hour come from the decoded minutes: all four clocks sit on
    # the trip's date, so this equals differencing the timestamps, without
    # building timestamp values per row for it.
    return df.select(
        d.alias("date"), *base,
        F.year(d).alias("year"), F.month(d).alias("month"), weekday_name(d).alias("day"),
        clock_timestamp(d, "sched_dep_time", minutes=sd).alias("sched_dep_ts"),
        clock_timestamp(d, "dep_time", shift_seconds, minutes=dm).alias("dep_ts"),
        clock_timestamp(d, "sched_arr_time", minutes=sa).alias("sched_arr_ts"),
        clock_timestamp(d, "arr_time", shift_seconds, minutes=am).alias("arr_ts"),
        F.when(known, delay_from_minutes(dm, sd, shift_seconds, wrap, round_result))
         .alias("dep_delay"),
        F.when(known, delay_from_minutes(am, sa, shift_seconds, wrap, round_result))
         .alias("arr_delay"),
        F.when(known, (F.floor(sd / 60) % 24).cast("int")).alias("hour"),
    )
