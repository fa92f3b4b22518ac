"""The counting analyses over a growing folder of flight files.

The study reads finished files once.  When new flight files keep landing in
a folder, the same answers can be kept up to date with Structured
Streaming: a file source with the declared schema, the same column
builders, and stateful aggregates whose state is one row per key.  No new
analysis is added here; these are Q5, Q8/Q9 counts and Q10 kept current.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.enrich import enrich_flights
from ..sources.schemas import FLIGHT_REQUIRED_COLUMNS, FLIGHTS


def read_flight_stream(spark: SparkSession, path: str, null_value: str = "NA",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Flight CSV files arriving in ``path`` (declared schema, header).  A file
    whose header names other columns, or these in another order, fails the
    query instead of being read by position."""
    r = (spark.readStream.schema(FLIGHTS).option("header", True).option("enforceSchema", False)
         .option("nullValue", null_value))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def _flown(stream: DataFrame, shift_seconds: int) -> DataFrame:
    # Row-local steps only (drop + clock columns); the group-mean fill needs
    # the whole table and is not part of these running counts.
    return enrich_flights(stream.na.drop(subset=list(FLIGHT_REQUIRED_COLUMNS)),
                          shift_seconds=shift_seconds)


def running_route_counts(stream: DataFrame, shift_seconds: int = 1) -> DataFrame:
    """Q5 kept current: origin, dest, route_freq (state: one row per route)."""
    return (_flown(stream, shift_seconds).groupBy("origin", "dest")
            .agg(F.count(F.lit(1)).alias("route_freq")))


def running_hourly_counts(stream: DataFrame, by: str = "carrier",
                          shift_seconds: int = 1) -> DataFrame:
    """Q8/Q9 input kept current: by, hour, count."""
    return (_flown(stream, shift_seconds).groupBy(by, "hour")
            .agg(F.count(F.lit(1)).alias("count")))


def running_delayed_share(stream: DataFrame, shift_seconds: int = 1) -> DataFrame:
    """Q10 for every origin at once: origin, total, delayed, delayed_pct."""
    late = F.count_if(F.col("dep_delay") > 0)
    total = F.count(F.lit(1))
    return (_flown(stream, shift_seconds).groupBy("origin")
            .agg(total.alias("total"), late.alias("delayed"),
                 F.try_divide(late * F.lit(100.0), total).alias("delayed_pct")))


def start_running(df: DataFrame, name: str, fmt: str, checkpoint_location: str,
                  output_mode: str = "complete", path: str | None = None) -> StreamingQuery:
    """Start a running analysis into a sink of format ``fmt``.  Its state and
    progress log go to ``checkpoint_location``, a folder all executors share; a
    query started again with the same one resumes where it stopped.  State is
    one row per key."""
    w = (df.writeStream.outputMode(output_mode).format(fmt).queryName(name)
         .option("checkpointLocation", checkpoint_location))
    if path:
        w = w.option("path", path)
    return w.start()
