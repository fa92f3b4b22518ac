"""Connected components over an edge table, wholly in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written, written_with


def _counted(df: DataFrame, name: str, what) -> tuple[DataFrame, int]:
    """``df`` written, and an aggregate of its rows seen by the same job."""
    table, seen = written_with(df, name, n=what)
    return table, seen["n"] or 0


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that is not the smallest of its
    component; a node without a row is its own component.

    Each round hooks every node on its smallest smaller neighbour, follows
    those pointers to their roots and contracts the edges to roots; a
    component of n nodes needs at most log2(n) rounds, a set of stars one.
    Minima are partial aggregates and every join reads a written table on
    both sides, so a hub with a third of all edges is one row per task in the
    aggregate and is split by the adaptive skew join.  Null endpoints and
    self-links are ignored.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e, n = _counted(e, "cc-edges", F.count(F.lit(1)))
    labels = None
    while n:
        hooks = written(e.groupBy("u").agg(F.min("v").alias("p")), "cc-hooks")
        moved = 1
        while moved:
            up = hooks.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            hooks, moved = _counted(
                hooks.join(up, "p", "left").select(
                    "u", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")),
                "cc-roots", F.count(F.when(F.col("moved"), 1)))
            hooks = hooks.select("u", "p")
        of_u = hooks.select("u", F.col("p").alias("ru"))
        of_v = hooks.select(F.col("u").alias("v"), F.col("p").alias("rv"))
        if labels is None:
            labels = hooks.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            to = hooks.select(F.col("u").alias("component"), F.col("p").alias("root"))
            labels = written(
                labels.join(to, "component", "left")
                .select("node", F.coalesce("root", "component").alias("component"))
                .unionByName(hooks.select(F.col("u").alias("node"), F.col("p").alias("component"))),
                "cc-labels")
        e = (e.join(of_u, "u").join(of_v, "v", "left")
             .select("ru", F.coalesce("rv", "v").alias("rv")).where("ru <> rv")
             .select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v")).distinct())
        e, n = _counted(e, "cc-edges", F.count(F.lit(1)))
    if labels is None:
        labels = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
