"""Q16-Q18: fuel cost against plane age and traits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAITS = ("type", "engines", "seats", "engine")


def fuel_by_year(planes: DataFrame) -> DataFrame:
    """Q16: manufacturing_year, avg_fuel_cc."""
    return (planes.groupBy("manufacturing_year")
            .agg(F.avg("fuel_cc").alias("avg_fuel_cc")).orderBy("manufacturing_year"))


def fuel_by_plane_traits(planes: DataFrame, traits: Sequence[str] = TRAITS) -> DataFrame:
    """Q17: mean fuel per trait combination, with a text label
    ``parameters`` ('<type> <engines> <seats> <engine>'; null if a part is)."""
    traits = list(traits)
    label = F.concat(*[p for t in traits for p in (F.lit(" "), F.col(t).cast("string"))][1:])
    return (planes.groupBy(*traits).agg(F.avg("fuel_cc").alias("avg_fuel_cc"))
            .withColumn("parameters", label)
            .orderBy(*traits))


def fuel_by_trait(planes: DataFrame, trait: str) -> DataFrame:
    """Q18: <trait>, avg_fuel_cc for one trait."""
    return planes.groupBy(trait).agg(F.avg("fuel_cc").alias("avg_fuel_cc")).orderBy(trait)


def fuel_by_each_trait(planes: DataFrame, traits: Sequence[str] = TRAITS) -> DataFrame:
    """Q18, all traits in one scan: ``GROUPING SETS ((type), (engines), ...)``
    -> trait, value (as text), avg_fuel_cc."""
    traits = list(traits)
    g = planes.groupingSets([[F.col(t)] for t in traits], *traits).agg(
        F.avg("fuel_cc").alias("avg_fuel_cc"),
        *[F.grouping(t).alias(f"_g_{t}") for t in traits])
    which = F.coalesce(*[F.when(F.col(f"_g_{t}") == 0, F.lit(t)) for t in traits])
    value = F.coalesce(*[F.when(F.col(f"_g_{t}") == 0, F.col(t).cast("string")) for t in traits])
    return g.select(which.alias("trait"), value.alias("value"), "avg_fuel_cc")
