"""Running totals over groups of any size, without a task per group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written


def hash_place(*cols: Column, seed: int) -> Column:
    """A hex digest of the values and the seed; its order is the shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols]))


def fraction(digest: Column) -> Column:
    """The digest as a number in [0, 1) in the same order (first 32 bits)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


#: Equal rows that one task makes out of their number.
EQUAL_ROWS = 100_000


def running(rows: DataFrame, group: list[str], place: Column, order: list[str],
            amount: Column, n_rows: int) -> DataFrame:
    """``rows`` with ``before`` (sum of ``amount`` over the rows ahead in the
    group) and ``total`` (over the whole group).

    ``place`` in [0, 1) must be monotone in ``order`` and about uniform over
    different rows; it deals the group into sqrt(n_rows) buckets.  Bucket totals
    are a partial aggregate, their prefix sums a window over sqrt(n_rows) rows a
    group, and rows are summed within a bucket only, so a group with a third of
    all rows takes no more memory in a task than any other.  Rows equal in every
    column are one row with their number until the end, however many they are,
    and come back EQUAL_ROWS at a time.  Rows are joined to their bucket, never
    to their group.  ``group`` columns must not be null.
    """
    names = rows.columns
    n = max(1, math.isqrt(max(0, n_rows - 1)) + 1)
    once = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    dealt = once.withColumns({"__bucket": F.least(F.floor(place * n), F.lit(n - 1)).cast("int"),
                              "__one": amount.cast("long"), "__amount": amount.cast("long") * F.col("__n")})
    totals = written(dealt.groupBy(*group, "__bucket").agg(F.sum("__amount").alias("__sum")), "bucket-totals")
    ahead = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(*group, "__bucket",
                            F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"),
                            F.sum("__sum").over(whole).alias("total"))
    inside = (Window.partitionBy(*group, "__bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = written(dealt.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
                     .join(offsets, [*group, "__bucket"])
                     .select(*names, "__n", "__one", (F.col("__ahead") + F.col("__inside")).alias("__first"), "total"),
                     "ranked-rows")
    # equal rows again, a stretch of each at a time; stretches are dealt anew where there are any
    stretch = placed.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(EQUAL_ROWS))))
    if placed.where(F.col("__n") > EQUAL_ROWS).head(1):
        stretch = stretch.repartition(F.xxhash64(*names, "__at"))
    row = F.explode(F.sequence("__at", F.least(F.col("__at") + EQUAL_ROWS, "__n") - 1))
    return (stretch.withColumn("__i", row).withColumn("before", F.col("__first") + F.col("__i") * F.col("__one"))
            .select(*names, "before", "total"))
