"""Column builders for dates, HHMM clocks and delays.

All of them are plain Catalyst expressions: they stay inside whole-stage
codegen, never call Python per row, and use ``timestamp_ntz`` so a wall
clock never meets the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

ColumnOrName = Column | str

# The date patterns of the study's two files.
FLIGHT_DATE_FORMATS = ("M/d/yyyy",)
WEATHER_DATE_FORMATS = ("M-d-yyyy", "M/d/yyyy")
# Weekday names in dayofweek() order (1 = Sunday), as pandas
# day_name() gives them.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# Fixed value: an "H:mm" clock at the start of the text or after a space/T.
HOUR_TEXT_PATTERN = r"(?:^|[ T])(\d{1,2}):\d{2}"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, formats: Sequence[str] = FLIGHT_DATE_FORMATS) -> Column:
    """H1: text to date, first pattern that fits; unparseable text -> null."""
    c = _c(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def date_of(df: DataFrame, name: str, formats: Sequence[str] = FLIGHT_DATE_FORMATS) -> Column:
    """H1 for a column of any type: text is parsed with ``formats``, a
    date is kept, a timestamp is cut to its date."""
    t = df.schema[name].dataType
    if isinstance(t, DateType):
        return df[name]
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return df[name].cast("timestamp_ntz").cast("date")
    return parse_date(df[name], formats)


def parse_hour(c: ColumnOrName) -> Column:
    """H5 on text of unknown shape ('2013-01-01 05:00:00', '1/1/2013 5:00',
    '5:00'): the hour of the wall clock, null when there is none.

    ISO text is cast to ``timestamp_ntz`` (no zone, so a clock inside a DST
    gap keeps its hour); other shapes fall back to the first H:mm clock.
    """
    c = _c(c)
    iso = F.hour(c.try_cast("timestamp_ntz"))
    h = F.regexp_extract(c, HOUR_TEXT_PATTERN, 1).try_cast("int")
    return F.coalesce(iso, F.when(h.between(0, 23), h)).cast("int")


def weekday_name(c: ColumnOrName) -> Column:
    """H3: full English weekday name ('Thursday'), whatever the JVM locale;
    an array lookup by ``dayofweek``, cheaper per row than a formatter."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.dayofweek(_c(c)))


def hhmm_minutes(c: ColumnOrName) -> Column:
    """H6: HHMM integer to minutes after midnight (517 -> 317, 2400 -> 1440).

    Same minutes as the study's "pad with 000, split off the last two
    digits" for every non-negative clock, without a string round trip.
    """
    c = _c(c)
    return (F.floor(c / 100) * 60 + c % 100).cast("int")


def hhmm_minutes_text(c: ColumnOrName) -> Column:
    """Clock that arrives as text ('517', '0005', '517.0'); text that is not
    a whole number from 0 on -> null."""
    n = F.trim(_c(c).cast("string")).try_cast("double")
    return hhmm_minutes(F.when((n >= 0) & (n == F.floor(n)), n))


def minutes_of(df: DataFrame, name: str) -> Column:
    """H6/H11 for a column of any type: integer clocks by arithmetic, clocks
    that arrived as text through the text decoder."""
    if isinstance(df.schema[name].dataType, StringType):
        return hhmm_minutes_text(df[name])
    return hhmm_minutes(df[name])


def clock_timestamp(date_c: ColumnOrName, hhmm_c: ColumnOrName,
                    shift_seconds: int = 0, minutes: Column | None = None) -> Column:
    """Date + HHMM clock -> timestamp_ntz, moved back ``shift_seconds``.

    The study moves actual clocks back 1 s (pandas) or 60 s (Spark), so an
    actual 2400 stays on the same date (23:59:59).  A scheduled 2400 lands
    on the next day 00:00, as datetime arithmetic says.  ``minutes`` may
    pass already decoded minutes (see :func:`minutes_of`).
    """
    m = hhmm_minutes(hhmm_c) if minutes is None else minutes
    secs = m * 60 - F.lit(shift_seconds)
    return F.timestamp_add("SECOND", secs, _c(date_c).cast("timestamp_ntz"))


def _wrap_round(d: Column, wrap: str | None, round_result: bool) -> Column:
    if wrap == "nearest":
        d = (F.when(d > 720, d - 1440).when(d < -720, d + 1440).otherwise(d))
    elif wrap is not None:
        raise ValueError(f"wrap must be None or 'nearest', not {wrap!r}")
    return F.round(d, 0) if round_result else d


def delay_minutes(actual_c: ColumnOrName, planned_c: ColumnOrName,
                  wrap: str | None = None, round_result: bool = False) -> Column:
    """H9: actual - planned in minutes (double), from two timestamps.

    ``wrap=None`` keeps the study's behaviour: both clocks sit on the trip's
    date, so planned 23:50 / left 00:10 is -1420.  ``wrap='nearest'`` moves
    the result by a day when it is more than 12 h away.  ``round_result``
    rounds half up to whole minutes like the Spark notebook.
    """
    d = F.timestamp_diff("SECOND", _c(planned_c), _c(actual_c)) / F.lit(60.0)
    return _wrap_round(d, wrap, round_result)


def delay_from_minutes(actual_min: Column, planned_min: Column, shift_seconds: int = 0,
                       wrap: str | None = None, round_result: bool = False) -> Column:
    """H9 when both clocks sit on the same date: the same minutes as
    :func:`delay_minutes` on their two timestamps, by integer arithmetic
    (no timestamp values built per row)."""
    secs = (actual_min - planned_min) * 60 - F.lit(shift_seconds)
    return _wrap_round(secs / F.lit(60.0), wrap, round_result)
