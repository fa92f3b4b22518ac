"""Group means as state that merges (B7, D1, D2): sums and counts per group.

A mean cannot be merged, its sum and count can.  The state of a day of files is
one small table; states of any parts add up to the state of the whole, and a part
that turns out wrong is taken out again by subtracting its state.  So a new day
is filled without reading the days before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import join_bounded
from .quality import _value


def mean_state(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keys, ``sum_<col>``, ``n_<col>``): one partial + final aggregate.  Missing
    values (null, NaN) add nothing."""
    aggs = [a for c in cols for a in (F.sum(_value(df, c).cast("double")).alias(f"sum_{c}"),
                                      F.count(_value(df, c)).alias(f"n_{c}"))]
    return df.groupBy(*keys).agg(*aggs)


def merged_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The state of all parts together: an aggregate over one row per group and part."""
    every = reduce(DataFrame.unionByName, states)
    return _merged(every, keys)


def _merged(every: DataFrame, keys: Sequence[str], sign=None) -> DataFrame:
    sign = F.lit(1) if sign is None else sign
    return every.groupBy(*keys).agg(*[F.sum(F.col(c) * sign).alias(c) for c in every.columns
                                      if c.startswith(("sum_", "n_")) and c not in keys])


def without_state(whole: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of ``whole`` without ``part``; groups that had nothing else go."""
    signed = whole.withColumn("__sign", F.lit(1)).unionByName(part.withColumn("__sign", F.lit(-1)))
    left = _merged(signed, keys, F.col("__sign"))
    return left.where(" OR ".join(f"{c} > 0" for c in left.columns if c.startswith("n_")))


def fill_from_state(df: DataFrame, state: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    max_groups: int | None = None) -> DataFrame:
    """B7 from a state: gaps in ``cols`` become the mean of their group; a group
    the state does not know, or knows no value of, and null keys stay unfilled.
    The state's side of the join is size-checked (:func:`join_bounded`)."""
    means = state.select(*keys, *[F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias(f"__mean_{c}") for c in cols])
    joined = join_bounded(df, means, list(keys), "left", max_rows=max_groups)
    return joined.select([F.coalesce(_value(joined, c).cast("double"), F.col(f"__mean_{c}")).alias(c) if c in cols
                          else F.col(f"`{c}`") for c in df.columns])


def save_state(state: DataFrame, path: str, part: str) -> None:
    """Keep the state of one part (a day, say) in a folder of its own; saving a
    part again replaces it, so a rerun after a lost driver counts nothing twice.

    The folder is written under a fresh name first and only then renamed, so a
    reader sees a whole part or none."""
    spark = state.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fresh, target = Path(f"{path}/.{part}-{uuid.uuid4().hex}"), Path(f"{path}/part={part}")
    state.write.parquet(str(fresh))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(fresh, target):
        raise OSError(f"state of part {part} stays at {fresh}")


def load_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The merged state of all parts in the folder."""
    return _merged(spark.read.parquet(path), keys)
