"""Dictionary decoding: a costly function of a text column with few distinct
values is computed once per value and looked up per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_bounded

_TEXT, _VALUE = "__dictionary_text", "__dictionary_value"


def decoded(df: DataFrame, column: str, decode: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``decode(column)`` in the place of ``column``.

    The distinct texts are a partial aggregate over one column; ``decode`` runs
    on them alone and the (text, value) table is written once, when this is
    called.  Rows meet it in a join behind the size check of
    :func:`join_bounded`: a broadcast lookup while the texts are few, a shuffle
    join beyond.  A null text decodes to null, as does one that ``decode``
    cannot read.
    """
    text = df.select(F.col(column).alias(_TEXT)).where(F.col(_TEXT).isNotNull()).distinct()
    dictionary = text.select(_TEXT, decode(F.col(_TEXT)).alias(_VALUE))
    looked_up = join_bounded(df.withColumnRenamed(column, _TEXT), dictionary, _TEXT, "left")
    return looked_up.select([F.col(_VALUE).alias(column) if c == column else F.col(f"`{c}`") for c in df.columns])
