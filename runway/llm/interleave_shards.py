"""Proportional stratified interleaving: seeded shuffle within each source,
order by fractional rank, cut into shards that all match the mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixing import source_key
from .ranks import fraction, hash_place, running
from .store import written


def interleave_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                      source_col: str = "source", seed: int = 29) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in its shard), ``source``.

    The k-th of n rows of a source in hash order gets the fractional rank
    (k + phase) / n, with a phase in [0, 1) from a seeded hash of the source;
    rows in the order of that rank are cut into ``shards`` runs whose lengths
    differ by one at most, so every shard holds each source in proportion (to
    within one row of the source and the cut's rounding).  The phases spread
    small sources: a million sources of one row lie evenly, not all in the middle.

    A null text has size 1 and checksum 0, a null source is a source of its
    own; null ids, repeated rows and ties are ordered by (rank, source, hash,
    id, checksum, size), and rows equal in all of them are interchangeable.
    Other columns are ignored; an empty table gives none.
    """
    rows = written(docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
        source_key(F.col(source_col)).alias("key"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),).withColumn(
            "place", hash_place(F.col("__id"), F.col("crc"), F.col("size"), seed=seed)), "shard-rows")
    n = rows.count()
    order = ["place", "__id", "crc", "size"]
    ranked = running(rows, ["key"], fraction(F.col("place")), order, F.lit(1), n)
    phase = fraction(hash_place(F.col("key"), seed=seed + 1))
    ranked = written(ranked.withColumn("rank", (F.col("before") + phase) / F.col("total"))
                     .drop("before", "total"), "shard-ranks")
    at = running(ranked.withColumn("everything", F.lit(0)), ["everything"], F.col("rank"),
                 ["rank", "key", *order], F.lit(1), n)
    shard = F.expr(f"cast(before * {shards} div {max(n, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return at.withColumn("shard", shard).select(
        F.col("__id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("before") - first).alias("slot"), F.col("__source").alias("source"))
