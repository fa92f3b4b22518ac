"""Counting, ranking and per-group best rows.

Ties are always broken on the keys ascending, so results never depend on
shuffle order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key (rows, not non-null values of some column)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
            prefix: str = "avg_") -> DataFrame:
    """Mean of ``cols`` per key, named ``avg_<col>``."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])


def top_n(df: DataFrame, by: str, keys: Sequence[str], k: int,
          ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``by`` (desc unless ``ascending``), ties by keys.

    ``orderBy(..).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own k best rows, and only k x tasks rows meet in one place.
    """
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(order, *[F.col(c).asc() for c in keys]).limit(k)


def top_n_sql(df: DataFrame, by: str, keys: Sequence[str], k: int) -> DataFrame:
    """The same top-k written as SQL text with ``row_number``.

    The frame is passed as a query parameter, so no global temp view is
    left behind.  Catalyst puts a ``TakeOrderedAndProject(k)`` under the
    global window, so each task hands over at most k rows and the window
    sees only k (``tests/test_plans.py``).
    """
    order = ", ".join([f"`{by}` DESC"] + [f"`{c}`" for c in keys])
    q = (f"SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn "
         f"FROM {{routes}}) WHERE rn <= {int(k)}")
    return df.sparkSession.sql(q, routes=df).drop("rn")


def argmax_by_group(df: DataFrame, group: str, item: str, score: str) -> DataFrame:
    """Per ``group`` the ``item`` with the highest (numeric) ``score``
    (smallest item on ties), with that score; a null score comes last.

    ``min_by`` over a (-score, item) struct is an ordinary aggregate:
    partial per task, no sort of the group and no window; ``item`` may be
    of any orderable type.
    """
    best = F.min_by(F.struct(F.col(item), F.col(score)),
                    F.struct(F.col(score).isNull(), -F.col(score), F.col(item)))
    return (df.groupBy(group).agg(best.alias("_best"))
            .select(group, F.col(f"_best.{item}").alias(item),
                    F.col(f"_best.{score}").alias(score)))


def columnwise_max(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """``groupby(g).max()`` as the study wrote it: each column's max on
    its own, so ``max_hour`` and ``max_count`` may come from different rows."""
    return df.groupBy(group).agg(*[F.max(c).alias(f"max_{c}") for c in cols])


def filtered_share(df: DataFrame, base, hit) -> DataFrame:
    """One pass for a count, a filtered count and their percentage.

    ``total`` counts rows matching ``base``; ``delayed`` those also matching
    ``hit``; the share is null, not an error, when ``total`` is 0.
    """
    scoped = df.where(base)
    total = F.count(F.lit(1))
    hits = F.count_if(hit)
    return scoped.agg(total.alias("total"), hits.alias("delayed"),
                      F.try_divide(hits * F.lit(100.0), total).alias("delayed_pct"))
