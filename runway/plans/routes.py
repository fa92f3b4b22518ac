"""Q5-Q7: busiest routes, carriers on the top routes, carrier totals.

Q6 and Q7 scan the trips once: the small (origin, dest, carrier) count
table is computed in one pass (partial + final aggregate) and checkpointed
to the shared folder; the route ranking, the join back and the carrier
totals all read that table.  (Left to Catalyst, the two branches differ
by an inferred ``isnotnull`` filter, so the exchange is not reused and the
whole trips join runs twice.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count_by, top_n, top_n_sql
from ..operators.joins import join_top_k, materialize

ROUTE = ("origin", "dest")


def _scope(trips: DataFrame, year: int | None) -> DataFrame:
    return trips if year is None else trips.where(F.col("year") == F.lit(year))


def route_counts(trips: DataFrame, year: int | None = None) -> DataFrame:
    """Origin, dest, route_freq."""
    return count_by(_scope(trips, year), ROUTE, "route_freq")


def busiest_routes(trips: DataFrame, k: int = 1, year: int | None = None) -> DataFrame:
    """Q5: the ``k`` routes with most trips (ties: smaller origin, dest first).

    ``year`` filters before the projection (the Spark notebook filtered on a
    column it had already projected away)."""
    return top_n(route_counts(trips, year), "route_freq", ROUTE, k)


def busiest_routes_sql(trips: DataFrame, k: int = 5, year: int | None = None) -> DataFrame:
    """A3: Q5 through SQL text with ``row_number() OVER (ORDER BY ...)``."""
    return top_n_sql(route_counts(trips, year), "route_freq", ROUTE, k)


def route_carrier_counts(trips: DataFrame, year: int | None = None,
                         rank_year: int | None = None) -> DataFrame:
    """Origin, dest, carrier, count, and ``ranked``: how many of these trips
    count for the ranking of routes (those of ``rank_year``, or all)."""
    ranked = F.count(F.lit(1)) if rank_year is None else F.count_if(F.col("year") == F.lit(rank_year))
    return (_scope(trips, year).groupBy(*ROUTE, "carrier")
            .agg(F.count(F.lit(1)).alias("count"), ranked.alias("ranked")))


def _top_routes_from(rc: DataFrame, k: int) -> DataFrame:
    """The ``k`` busiest routes; a route without ranked trips is none."""
    routes = rc.groupBy(*ROUTE).agg(F.sum("ranked").alias("route_freq")).where("route_freq > 0")
    return top_n(routes, "route_freq", ROUTE, k).select(*ROUTE)


def carriers_on_top_routes(trips: DataFrame, k: int = 5, year: int | None = None,
                           rank_year: int | None = None) -> DataFrame:
    """Q6: trips per carrier on the ``k`` busiest routes, sorted by keys.

    ``year`` limits the whole question to a year.  ``rank_year`` limits the
    ranking only, as the Spark notebook does: the routes are the busiest of that
    year, their trips are counted over all years.  Both counts come from one
    conditional aggregate, one pass over the trips."""
    rc = materialize(route_carrier_counts(trips, year, rank_year))
    return (join_top_k(rc, _top_routes_from(rc, k), ROUTE, k)
            .select("origin", "dest", "carrier", "count")
            .orderBy("origin", "dest", "carrier"))


def carrier_totals(trips: DataFrame, year: int | None = None) -> DataFrame:
    """Carrier, count2 (all trips of each carrier), sorted by carrier."""
    return count_by(_scope(trips, year), ["carrier"], "count2").orderBy("carrier")


def carrier_route_vs_total(trips: DataFrame, k: int = 5, year: int | None = None,
                           rank_year: int | None = None) -> DataFrame:
    """Q7: Q6 next to each carrier's total trips (``count2``; of all years under
    ``rank_year``).

    Both sides are aggregates of the one count table; AQE picks the join
    from their runtime sizes.
    """
    rc = materialize(route_carrier_counts(trips, year, rank_year))
    top = (join_top_k(rc, _top_routes_from(rc, k), ROUTE, k)
           .select("origin", "dest", "carrier", "count"))
    totals = rc.groupBy("carrier").agg(F.sum("count").alias("count2"))
    return (top.join(totals, "carrier", "inner")
            .select("carrier", "origin", "dest", "count", "count2")
            .orderBy("origin", "dest", "carrier"))
