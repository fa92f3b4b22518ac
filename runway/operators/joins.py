"""Join helpers: broadcast only behind a size check, shuffle join beyond it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

from ..session import written, written_with

#: Bounds a checked side must stay within to be broadcast: rows, and bytes of
#: its rows as Spark holds them, far below ``spark.sql.maxBroadcastTableSize``.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

#: Bytes of a hash table entry: its row's header, pointer and address.
ENTRY_BYTES = 40
#: From this many rows on a top-k side is measured like any other.
MAX_TOP_K = 10_000


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row of ``df`` takes in a built relation: null bits, 8 per field,
    text/binary values rounded up to words, and its hash table entry (nested
    values are not expected here; 64 each)."""
    fixed, var = ENTRY_BYTES + 8 * (-(-len(df.columns) // 64)) + 8 * len(df.columns), []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            var.append(F.coalesce(F.octet_length(df[f.name]) + 7, F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, DecimalType)):
            fixed += 64
    return reduce(lambda a, b: a + b, var, F.lit(fixed).cast("long"))


def join_bounded(big: DataFrame, small: DataFrame, on: Sequence[str] | str,
                 how: str = "inner", max_rows: int | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """Join ``big`` to a side that is *expected* to be small.

    The small side (usually an aggregate of ``big``) is first written to the
    shared folder, which cuts its lineage and survives executor loss; its rows
    and bytes are measured by an ``Observation`` riding on that same write job,
    so the check costs no extra pass.  Within both bounds it is broadcast and
    the big side is never shuffled; beyond them the join is left to a shuffle
    join, where AQE can still split skewed partitions of the big side.
    The write runs when this function is called.
    """
    side, fits = measured(small, max_rows, max_bytes)
    side = F.broadcast(side) if fits else side
    return big.join(side, list(on) if not isinstance(on, str) else on, how)


def measured(small: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``small`` written to the shared folder, and whether it is within the
    bounds of a broadcast."""
    max_rows = DEFAULT_MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    side, seen = written_with(small, "bounded-side", rows=F.count(F.lit(1)), bytes=F.sum(row_bytes(small)))
    return side, (seen["rows"] or 0) <= max_rows and (seen["bytes"] or 0) <= max_bytes


def join_top_k(big: DataFrame, top: DataFrame, on: Sequence[str], k: int, how: str = "inner") -> DataFrame:
    """Join to a side that ends in ``limit(k)``: bounded by ``k`` by construction,
    so it is broadcast without a check up to MAX_TOP_K rows and measured beyond."""
    if k > MAX_TOP_K:
        return join_bounded(big, top, on, how)
    return big.join(F.broadcast(top), list(on), how)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and reuse it: a table in the shared folder (lineage
    cut, survives executor loss).  Meant for small derived tables that several
    branches of one analysis read.  The write runs when this is called."""
    return written(df, "shared-table")
