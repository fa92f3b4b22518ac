"""Adapters: the driver tables cast in the study's roles.

No flights, weather or planes files ship with the study, so the driver's
tables stand in for them (SURVEY §7.3).  Every role is a lazy DataFrame
derived from whole tables, so its size grows with the input.

* ``trips``: lineitem ⋈ supplier ⋈ (orders ⋈ customer).  origin = supplier
  nation, dest = customer nation, carrier = order priority, flight = order
  key, date = order date, ``dep_delay`` = days from order to ship, in minutes.
* ``clock_trips``: ``events`` shaped exactly like the study's flights file
  (HHMM integer clocks, ``M/d/yyyy`` date text, nullable dep/arr/tailnum,
  airport codes as text: origin ``'0'..'2'``, dest ``'0'..'4'``).
* ``weather``: ``view`` events summarised by (day, hour, ``user_id % 3``),
  shaped like the study's weather file (``M-d-yyyy`` date text, an hour
  timestamp as text, gaps in seven measures).
* ``fleet``: ``part`` shaped like the study's planes file.

The modulo expressions below only *derive* values and gaps; no row is
ever filtered out by them.  Measures that get averaged are built with
``sqrt`` so their means never sit exactly on a rounding tie (the source
values have two decimals); ``sqrt`` is correctly rounded in every engine,
so the SQL oracle computes the very same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _hhmm(minutes: str) -> str:
    """SQL for minutes after midnight -> HHMM integer (1440 -> 2400)."""
    return f"CAST(floor({minutes} / 60) * 100 + {minutes} % 60 AS INT)"


# The roles are written as Spark SQL expressions (``selectExpr``): one call
# per projection instead of one per operator, the same plan for Catalyst.

def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem.

    Join order is chosen for scale: the small supplier side meets lineitem
    first (Catalyst broadcasts it only while its scan is under the size
    threshold, AQE re-checks at runtime), orders meets customer before
    lineitem, so the fact table is shuffled once, on the order key.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_shipdate"])
    od = read_table(spark, sf_dir, "orders",
                    ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    su = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])

    orders_dest = od.join(cu, od.o_custkey == cu.c_custkey)
    lines_origin = li.join(su, li.l_suppkey == su.s_suppkey)
    t = lines_origin.join(orders_dest, lines_origin.l_orderkey == orders_dest.o_orderkey)
    return t.selectExpr(
        "s_nationkey AS origin",
        "c_nationkey AS dest",
        "o_orderpriority AS carrier",
        "l_orderkey AS flight",
        "CAST(o_orderdate AS DATE) AS date",
        "year(o_orderdate) AS year",
        "datediff(l_shipdate, o_orderdate) * 1440.0D AS dep_delay",
    )


def _spread(ev: DataFrame, months: int) -> DataFrame:
    """The events over ``months`` months: ``event_id % months`` months later."""
    return ev if months == 1 else ev.withColumn("ts", F.expr(f"ts + make_ym_interval(0, CAST(event_id % {months} AS INT))"))


def clock_trips(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    """``events`` as a flights file (schema ``schemas.FLIGHTS``), spread over
    ``months`` months.

    Scheduled departure = the event's clock; actual departure = scheduled
    + (event_id % 61) - 15 minutes, kept inside the day; scheduled arrival
    = departure + 30..180 minutes (capped at 24:00); actual arrival =
    scheduled + (event_id % 37) - 8 minutes, kept inside the day.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    m = (_spread(ev, months).selectExpr("*", "hour(ts) * 60 + minute(ts) AS sd")
         .selectExpr("*", "least(greatest(sd + event_id % 61 - 15, 1), 1440) AS dm",
                     "least(sd + 30 + event_id % 151, 1440) AS sa")
         .selectExpr("*", "least(greatest(sa + event_id % 37 - 8, 1), 1440) AS am"))
    return m.selectExpr(
        "date_format(ts, 'M/d/yyyy') AS date",
        f"{_hhmm('sd')} AS sched_dep_time",
        f"CASE WHEN event_id % 13 != 0 THEN {_hhmm('dm')} END AS dep_time",
        f"{_hhmm('sa')} AS sched_arr_time",
        f"CASE WHEN event_id % 17 != 0 THEN {_hhmm('am')} END AS arr_time",
        "event_type AS carrier",
        "event_id AS flight",
        "CASE WHEN event_id % 11 != 0 THEN concat('N', CAST(user_id AS STRING)) END AS tailnum",
        "CAST(user_id % 3 AS STRING) AS origin",
        "CAST(user_id % 5 AS STRING) AS dest",
        "CASE WHEN event_id % 7 != 0 THEN sqrt(value) * 10 END AS air_time",
    )


def weather(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    """Hourly conditions per origin (schema ``schemas.WEATHER``), with gaps,
    over as many months as :func:`clock_trips`."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    g = (_spread(ev, months).groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hr"),
                  (F.col("user_id") % 3).cast("string").alias("origin"))
         .agg(F.count(F.lit(1)).alias("n"), F.avg(F.sqrt("value")).alias("mean"),
              F.min("value").alias("lo"), F.max("value").alias("hi"),
              F.sum("value").alias("tot")))
    return g.selectExpr(
        "origin",
        "date_format(day, 'M-d-yyyy') AS date",
        "concat(date_format(day, 'yyyy-MM-dd'), ' ', lpad(CAST(hr AS STRING), 2, '0'), ':00:00')"
        " AS hour_sched_dep",
        "CASE WHEN hr % 6 != 0 THEN mean * 10 END AS temp",
        "CASE WHEN hr % 8 != 5 THEN sqrt(lo) * 10 END AS dewp",
        "CASE WHEN hr % 7 != 3 THEN sqrt(hi) * 10 END AS humid",
        "CAST(n * 10 AS DOUBLE) AS wind_dir",
        "CASE WHEN hr % 9 != 4 THEN CAST(floor(hi) % 25 AS DOUBLE) END AS wind_speed",
        "CASE WHEN hr % 4 != 1 THEN sqrt(hi - lo) * 10 END AS wind_gust",
        "CASE WHEN hr % 5 != 2 THEN sqrt(tot) + 1000 END AS pressure",
        "CAST(least(n, 10) AS DOUBLE) AS visib",
    )


def weather_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as it comes in: one report per event kind, so most (date, origin,
    hour) have several.  ``reported`` is the last event a report knows of."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    g = (ev.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hr"),
                    (F.col("user_id") % 3).cast("string").alias("origin"), "event_type")
         .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
              F.max("event_id").alias("reported")))
    return g.selectExpr(
        "origin",
        "date_format(day, 'M-d-yyyy') AS date",
        "concat(date_format(day, 'yyyy-MM-dd'), ' ', lpad(CAST(hr AS STRING), 2, '0'), ':00:00')"
        " AS hour_sched_dep",
        "event_type AS station",
        "reported",
        "sqrt(lo) * 10 AS temp",
        "CAST(n * 10 AS DOUBLE) AS wind_dir",
        "CASE WHEN hr % 9 != 4 THEN CAST(floor(hi) % 25 AS DOUBLE) END AS wind_speed",
        "sqrt(hi) + 1000 AS pressure",
        "CAST(least(n, 10) AS DOUBLE) AS visib",
    )


def weather_text(df: DataFrame, sentinel: str = "NA") -> DataFrame:
    """Weather as text, gaps written as ``sentinel`` (how the study's CSV
    arrived when read without ``nullValue``)."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit(sentinel)).alias(c)
                      for c in df.columns])


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a planes file (schema ``schemas.PLANES``); ``speed`` is 90 %
    null and ``seats`` has gaps."""
    p = read_table(spark, sf_dir, "part",
                   ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    return p.selectExpr(
        "concat('N', CAST(p_partkey AS STRING)) AS tailnum",
        "CAST(p_partkey % 57 + 1956 AS INT) AS manufacturing_year",
        "p_type AS type",
        "p_size % 4 + 1 AS engines",
        "CASE WHEN p_partkey % 13 != 0 THEN p_size END AS seats",
        "p_brand AS engine",
        "sqrt(p_retailprice) * 10 AS fuel_cc",
        "CASE WHEN p_partkey % 10 = 0 THEN p_size * 10 END AS speed",
    )
