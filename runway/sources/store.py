"""Materialise a working table once, partitioned for pruning or bucketed for joins.

The notebooks re-read and re-cleaned their CSVs for every action.  Here a
derived table (enriched trips, say) is written once as Parquet in hive
layout, partitioned by columns later filters use (``year``, ``month``), so
``where(year == ...)`` reads only the matching folders (``PartitionFilters``
in the plan).  There is no plain repartition before the write: that would send a
whole month to one task; a rebalance hint lets the adaptive plan merge small
and split large partitions of the write instead, so the number of files
follows the data's size and not tasks times partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import measured
from ..session import bucketed


def store_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("year", "month"),
                      mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> None:
    (df.hint("rebalance", *partition_by).write.mode(mode).format("parquet")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_by)
       .save(path))


def load_stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: Rows of one key that stay together in a stored side; keys with more are dealt out.
MAX_KEY_ROWS = 1_000_000
_PART = "__join_part"


@dataclass(frozen=True)
class JoinSides:
    """Two tables stored for repeated inner joins on ``keys``.

    Both are bucketed and sorted by the keys and a part number, so their join has
    no exchange on either side.  A key of the left side with more rows than the
    store's bound is dealt over several parts (by a hash of the whole row), and
    the right rows of that key stand in each of its parts; every pair of rows
    still meets once.  Rows with a null key are kept and join nothing."""

    left: DataFrame
    right: DataFrame
    keys: tuple[str, ...]

    def joined(self) -> DataFrame:
        return self.left.hint("merge").join(self.right, [*self.keys, _PART]).drop(_PART)


def store_join_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int | None = None,
                     max_key_rows: int = MAX_KEY_ROWS) -> JoinSides:
    """Store both sides (three writes when called: hot keys, left, right).

    The rows per key are a partial aggregate; hot keys are at most the left rows
    divided by ``max_key_rows``, and meet both sides behind the size check of
    :func:`join_bounded`, so the left side is shuffled once, into its buckets.
    The right side must hold few rows per key (an hour's weather), as those of a
    hot key are repeated once per part."""
    keys = tuple(keys)
    count = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_key_rows)
    hot = count.select(*keys, F.ceil(F.col("n") / max_key_rows).cast("int").alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    side, fits = measured(hot)
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), parts).cast("int")
    out = []
    for df, part in ((left, dealt), (right, F.explode(F.sequence(F.lit(0), parts - 1)))):
        met = df.join(F.broadcast(side) if fits else side, list(keys), "left")
        out.append(bucketed(met.select(*[F.col(f"`{c}`") for c in df.columns], part.alias(_PART)), [*keys, _PART],
                            "join-side", buckets))
    return JoinSides(*out, keys)
