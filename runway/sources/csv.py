"""A1/A2: typed CSV scans and CSV/Parquet sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, ShortType, StringType,
                               StructField, StructType)

from ..session import scratch_path
from . import schemas

_BROKEN = "__broken_line"
_BAD = StructType([StructField("column", StringType()), StructField("cell", StringType())])


def _text(spark: SparkSession, path: str, schema: StructType, null_value: str) -> DataFrame:
    """The file's columns as text, by the names of its header; ``null_value``
    text is null.  A declared column that the header lacks is an error."""
    df = spark.read.option("header", True).option("nullValue", null_value).csv(path)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header ({', '.join(df.columns)})")
    return df


def _parsed(field: StructField) -> Column:
    """A text cell as its declared type; whole numbers may have a zero fraction
    (``517.0``), which is cut off as text, so each cell is cast once."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType):
        return c
    if isinstance(field.dataType, (IntegerType, LongType, ShortType)):
        whole = F.substring_index(c, ".", 1)
        fraction = F.rtrim(F.substring(c, F.length(whole) + 2, F.length(c)))
        c = F.when(F.translate(fraction, "0", "") == "", whole)
    return F.trim(c).try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: StructType,
             null_value: str = "NA") -> DataFrame:
    """Header CSV with declared types; ``null_value`` text becomes null.

    Columns are found by name: the file may hold them in any order, and others
    beside them, which stay behind.  The header is read when this is called;
    types are declared, so they never depend on what the data happens to hold.
    A cell that does not parse is null; :func:`unparsed_counts` counts those.
    """
    text = _text(spark, path, schema, null_value)
    return text.select(*[_parsed(f).alias(f.name) for f in schema.fields])


def read_csv_checked(spark: SparkSession, path: str, schema: StructType,
                     null_value: str = "NA") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a header CSV: the rows whose every cell parses, typed,
    and per cell that does not (file, row_text, column, cell).

    One pass: each line is parsed once into its values and its list of bad cells
    and written; rows and rejects are the two folders of that one write, so each
    reads its own files only.  The pass runs when this is called.

    A line with more or fewer cells than the header is a reject without column
    and cell.  ``null_value`` text and empty cells are null, which is no reject.
    Lines are lines of the file (a quoted cell holds no line break); the header
    stands first in every file and is known by its text.
    """
    names = _text(spark, path, schema, null_value).columns
    header = spark.read.text(path).first()[0]
    cells = ", ".join(f"`{n}` string" for n in [*names, _BROKEN])
    lines = spark.read.text(path).where(F.col("value") != F.lit(header)).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("row_text"),
        F.from_csv("value", cells, {"nullValue": null_value, "columnNameOfCorruptRecord": _BROKEN}).alias("cells"))
    flat = lines.select("file", "row_text", "cells.*")
    broken = F.when(F.col(_BROKEN).isNotNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("cell"))))
    bad = F.array_compact(F.array(*[
        F.when(_parsed(f).isNull() & F.col(f"`{f.name}`").isNotNull(),
               F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("cell")))
        for f in schema.fields if not isinstance(f.dataType, StringType)] or [F.lit(None).cast("struct<column:string,cell:string>")]))
    judged = flat.select("file", "row_text", F.coalesce(broken, bad).alias("bad"),
                         F.struct(*[_parsed(f).alias(f.name) for f in schema.fields]).alias("row"))
    good = F.size("bad") == 0
    out = scratch_path(spark, "csv-checked")
    (judged.select(good.alias("good"), "bad", F.when(good, F.col("row")).alias("row"),
                   F.when(~good, F.col("file")).alias("file"), F.when(~good, F.col("row_text")).alias("row_text"))
     .write.partitionBy("good").parquet(out))
    kinds = StructType([StructField("good", BooleanType()), StructField("row", schema),
                        StructField("bad", ArrayType(_BAD)), StructField("file", StringType()), StructField("row_text", StringType())])
    stored = spark.read.schema(kinds).parquet(out)
    rejects = stored.where(~F.col("good")).select("file", "row_text", F.explode("bad").alias("b"))
    return stored.where("good").select("row.*"), rejects.select("file", "row_text", "b.column", "b.cell")


def unparsed_counts(spark: SparkSession, path: str, schema: StructType,
                    null_value: str = "NA") -> DataFrame:
    """One row: per declared column, the cells that hold text but not a value
    of its type (one scan, one aggregate)."""
    text = _text(spark, path, schema, null_value)
    return text.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & _parsed(f).isNull()).alias(f.name)
                      for f in schema.fields])


def read_flights(spark: SparkSession, path: str, null_value: str = "NA") -> DataFrame:
    return read_csv(spark, path, schemas.FLIGHTS, null_value)


def read_weather(spark: SparkSession, path: str, null_value: str = "NA") -> DataFrame:
    return read_csv(spark, path, schemas.WEATHER, null_value)


def read_planes(spark: SparkSession, path: str, null_value: str = "NA") -> DataFrame:
    return read_csv(spark, path, schemas.PLANES, null_value)


def write_table(df: DataFrame, path: str, fmt: str = "csv",
                mode: str = "overwrite", partition_by: list[str] | None = None,
                null_value: str | None = None) -> None:
    """Write ``df`` as a directory of part files (header on for CSV, no index).

    Each task writes its own part, so the sink scales with the cluster;
    there is no single-file output.
    """
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
        if null_value is not None:
            w = w.option("nullValue", null_value)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
