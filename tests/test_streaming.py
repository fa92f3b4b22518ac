"""Streaming counts equal the batch analyses on the same flight files."""

import uuid

from pyspark.sql import functions as F

from runway import catalog
from runway.operators.quality import frames_equal
from runway.plans.delays import delayed_share
from runway.plans.enrich import enrich_flights
from runway.session import scratch_path
from runway.sources.csv import write_table
from runway.streaming.incremental import (read_flight_stream, running_delayed_share,
                                          running_route_counts, start_running)

from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    src = scratch_path(spark, "flight-stream")
    raw = catalog.raw_flights(spark, SF_SMALL)
    # two batches of files land in the folder
    write_table(raw.where(F.col("flight") % 2 == 0), src + "/part-a", "csv", null_value="NA")
    write_table(raw.where(F.col("flight") % 2 == 1), src + "/part-b", "csv", null_value="NA")
    stream = read_flight_stream(spark, src + "/*", max_files_per_trigger=2)
    name_r, name_s = f"routes_{uuid.uuid4().hex}", f"share_{uuid.uuid4().hex}"
    q1 = start_running(running_route_counts(stream), name_r, "memory", scratch_path(spark, name_r))
    q2 = start_running(running_delayed_share(stream), name_s, "memory", scratch_path(spark, name_s))
    try:
        q1.processAllAvailable()
        q2.processAllAvailable()
        flown = enrich_flights(raw.na.drop(subset=["dep_time", "arr_time", "tailnum"]))
        batch_routes = flown.groupBy("origin", "dest").agg(F.count(F.lit(1)).alias("route_freq"))
        assert frames_equal(spark.table(name_r), batch_routes)
        got = {r.origin: (r.total, r.delayed) for r in spark.table(name_s).collect()}
        for o in got:
            b = delayed_share(flown, o).first()
            assert got[o] == (b.total, b.delayed)
    finally:
        q1.stop()
        q2.stop()


def test_stream_hourly_counts_match_batch(spark):
    from runway.plans.hours import hourly_counts
    from runway.streaming.incremental import running_hourly_counts
    src = scratch_path(spark, "flight-stream-hours")
    raw = catalog.raw_flights(spark, SF_SMALL)
    write_table(raw, src, "csv", null_value="NA")
    name = f"hours_{uuid.uuid4().hex}"
    q = start_running(running_hourly_counts(read_flight_stream(spark, src), "origin"), name, "memory",
                      scratch_path(spark, name))
    try:
        q.processAllAvailable()
        flown = enrich_flights(raw.na.drop(subset=["dep_time", "arr_time", "tailnum"]))
        assert frames_equal(spark.table(name), hourly_counts(flown, "origin"))
    finally:
        q.stop()


def test_stream_refuses_columns_in_another_order(spark):
    import pytest
    from pyspark.errors import StreamingQueryException
    src = scratch_path(spark, "flight-stream-reversed")
    raw = catalog.raw_flights(spark, SF_SMALL)
    write_table(raw.select(*reversed(raw.columns)), src, "csv", null_value="NA")
    name = f"reversed_{uuid.uuid4().hex}"
    q = start_running(running_route_counts(read_flight_stream(spark, src)), name, "memory", scratch_path(spark, name))
    try:
        with pytest.raises(StreamingQueryException):
            q.processAllAvailable()
    finally:
        q.stop()
