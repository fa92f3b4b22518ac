"""Q20/Q21: the small frames behind the notebooks' charts.

Drawing stays outside the library; these return the sorted series, the
pairwise correlations and the binned counts a chart would show.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chart_series(df: DataFrame, x: str, y: str) -> DataFrame:
    """Q20: the (x, y) points of a line/bar/scatter chart, sorted by x."""
    return df.select(x, y).orderBy(x)


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one aggregation
    -> col_a, col_b, corr."""
    pairs = list(combinations(cols, 2))
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(f"p{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(rows))


def _bin(v: Column, lo: float | None, hi: float | None, bins: int) -> Column:
    """Equal-width bin 1..bins of ``v`` over [lo, hi]; values at or beyond an end
    land in the end bin; null when ``v`` is null or NaN."""
    v = F.when(~F.isnan(v.cast("double")), v)
    if lo is None or hi is None or hi == lo:
        return F.when(v.isNotNull(), F.lit(1))
    x = F.floor((v.cast("double") - F.lit(float(lo))) * F.lit(float(bins))
                / F.lit(float(hi) - float(lo)))
    return F.when(v.isNotNull(), F.greatest(F.lit(1), F.least(x + 1, F.lit(bins)))).cast("int")


def binned_counts(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Per column, rows per equal-width bin -> col, bin, count.

    The bounds are one aggregate row (bounded by the column count); each
    row then yields one (column, bin) pair per column and the counts are a
    partial + final aggregate.
    """
    cols = list(cols)
    there = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in cols]
    b = df.agg(*[F.min(v).alias(f"lo{i}") for i, v in enumerate(there)],
               *[F.max(v).alias(f"hi{i}") for i, v in enumerate(there)]).first()
    pairs = F.array(*[F.struct(F.lit(c).alias("col"),
                               _bin(F.col(c), b[f"lo{i}"], b[f"hi{i}"], bins).alias("bin"))
                      for i, c in enumerate(cols)])
    return (df.select(F.inline(pairs))
            .groupBy("col", "bin").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("col", "bin"))


def pairwise_series(df: DataFrame, cols: Sequence[str],
                    bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """Q21: what a pair plot shows, as two frames: the correlation of each
    column pair, and each column's binned counts."""
    return pairwise_corr(df, cols), binned_counts(df, cols, bins)
