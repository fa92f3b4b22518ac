"""Sources and sinks: typed CSV reads with NA, partitioned writes, stored tables."""

from pyspark.sql import functions as F

from runway.operators.quality import frames_equal
from runway.session import scratch_path
from runway.sources import roles
from runway.sources.csv import read_planes, write_table
from runway.sources.schemas import PLANES
from runway.sources.store import load_stored, store_partitioned

from conftest import SF_SMALL


def test_planes_csv_with_na(spark, tmp_path):
    p = tmp_path / "planes.csv"
    p.write_text("tailnum,manufacturing_year,type,engines,seats,engine,fuel_cc,speed\n"
                 "N1,2004,Fixed wing,2,55,Turbo-fan,12.5,NA\n"
                 "N2,NA,Fixed wing,2,NA,Turbo-fan,10.0,NA\n")
    df = read_planes(spark, str(p))
    assert df.schema == PLANES
    rows = df.orderBy("tailnum").collect()
    assert rows[0].seats == 55 and rows[0].speed is None
    assert rows[1].manufacturing_year is None and rows[1].seats is None


def test_partitioned_parquet_sink_and_pruning(spark):
    fleet = roles.fleet(spark, SF_SMALL)
    path = scratch_path(spark, "fleet-by-engines")
    write_table(fleet, path, "parquet", partition_by=["engines"])
    back = spark.read.parquet(path)
    assert frames_equal(back.select(*fleet.columns), fleet)
    plan = back.where(F.col("engines") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(engines" in plan


def test_store_partitioned_round_trip(spark):
    trips = roles.trips(spark, SF_SMALL)
    path = scratch_path(spark, "trips-store")
    store_partitioned(trips, path, partition_by=("year",), max_records_per_file=500)
    back = load_stored(spark, path)
    assert frames_equal(back.select(*trips.columns), trips)


def test_store_makes_few_files(spark):
    import os
    df = spark.range(0, 20_000, numPartitions=20).selectExpr("id", "id % 40 AS part")
    path = scratch_path(spark, "few-files")
    store_partitioned(df, path, partition_by=("part",))
    files = [f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.startswith("part-")]
    assert 40 <= len(files) <= 80


def test_csv_by_header_name(spark):
    import pytest

    from runway.sources.csv import read_flights, unparsed_counts
    from runway.sources.schemas import FLIGHTS
    from runway import catalog
    raw = catalog.raw_flights(spark, SF_SMALL)
    path = scratch_path(spark, "reordered")
    odd = raw.select(F.lit("x").alias("more"), *reversed(raw.columns)).withColumn(
        "dep_time", F.when(F.col("flight") % 2 == 0, F.concat(F.col("dep_time").cast("string"), F.lit(".0")))
        .otherwise(F.col("dep_time").cast("string")))
    write_table(odd, path, "csv", null_value="NA")
    assert frames_equal(read_flights(spark, path), raw.select(*FLIGHTS.names))
    assert set(unparsed_counts(spark, path, FLIGHTS).first()) == {0}
    bad = scratch_path(spark, "bad")
    write_table(odd.withColumn("dep_time", F.lit("soon")), bad, "csv", null_value="NA")
    assert unparsed_counts(spark, bad, FLIGHTS).first()["dep_time"] == raw.count()
    short = scratch_path(spark, "short")
    write_table(odd.drop("carrier"), short, "csv", null_value="NA")
    with pytest.raises(ValueError, match="carrier"):
        read_flights(spark, short)
