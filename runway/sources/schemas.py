"""Declared schemas for the three study inputs (flights, weather, planes).

The study's CSVs were read with schema inference, which costs extra jobs
and turns a numeric column holding the text ``NA`` into a string column.
A declared schema plus ``nullValue`` gives typed columns in one pass.
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

FLIGHTS = StructType([
    StructField("date", StringType()),            # M/d/yyyy
    StructField("sched_dep_time", IntegerType()),  # HHMM
    StructField("dep_time", IntegerType()),        # HHMM, null = did not leave
    StructField("sched_arr_time", IntegerType()),
    StructField("arr_time", IntegerType()),
    StructField("carrier", StringType()),
    StructField("flight", LongType()),
    StructField("tailnum", StringType()),
    StructField("origin", StringType()),           # airport code
    StructField("dest", StringType()),
    StructField("air_time", DoubleType()),
])

WEATHER = StructType([
    StructField("origin", StringType()),
    StructField("date", StringType()),             # M-d-yyyy (or M/d/yyyy)
    StructField("hour_sched_dep", StringType()),   # timestamp text
    StructField("temp", DoubleType()),
    StructField("dewp", DoubleType()),
    StructField("humid", DoubleType()),
    StructField("wind_dir", DoubleType()),
    StructField("wind_speed", DoubleType()),
    StructField("wind_gust", DoubleType()),
    StructField("pressure", DoubleType()),
    StructField("visib", DoubleType()),
])

PLANES = StructType([
    StructField("tailnum", StringType()),
    StructField("manufacturing_year", IntegerType()),
    StructField("type", StringType()),
    StructField("engines", IntegerType()),
    StructField("seats", IntegerType()),
    StructField("engine", StringType()),
    StructField("fuel_cc", DoubleType()),
    StructField("speed", IntegerType()),
])

#: The weather columns the study fills with the (origin, date) mean.
WEATHER_FILL_COLUMNS = ("temp", "dewp", "humid", "wind_dir", "wind_speed",
                        "wind_gust", "pressure")

#: Columns whose null means the flight did not fly; such rows are dropped.
FLIGHT_REQUIRED_COLUMNS = ("dep_time", "arr_time", "tailnum")
