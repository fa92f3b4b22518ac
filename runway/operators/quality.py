"""Data-quality operators.

Every profile is **one** aggregation over the whole frame: one scan, a
partial aggregate per task and a one-row final merge, however many
columns there are (the notebook ran one job per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from .joins import join_bounded


def _q(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    """Text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _missing_sql(name: str, data_type) -> str:
    """Null, and NaN for floating columns (pandas counts both as missing)."""
    q = _q(name)
    if isinstance(data_type, (DoubleType, FloatType)):
        return f"({q} IS NULL OR isnan({q}))"
    return f"{q} IS NULL"


def _value(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing (null) for floating columns, so
    means skip it and fills replace it, as pandas does."""
    c = df[name]
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(c), c)
    return c


# The column-wise profiles are single ``selectExpr`` projections: one
# aggregate over the frame, built in one call however many columns it has.

def null_counts(df: DataFrame) -> DataFrame:
    """B1: one row, one long column per input column: missing values."""
    return df.selectExpr(*[f"count_if({_missing_sql(f.name, f.dataType)}) AS {_q(f.name)}"
                           for f in df.schema.fields])


def sentinel_counts(df: DataFrame, value: str = "NA") -> DataFrame:
    """B2: per column, cells equal to the text ``value``.

    Only string columns can hold the text; other columns report 0 (comparing
    a number with 'NA' raises under ANSI).
    """
    return df.selectExpr(*[
        (f"count_if({_q(f.name)} = {_lit(value)})" if isinstance(f.dataType, StringType)
         else "CAST(0 AS BIGINT)") + f" AS {_q(f.name)}"
        for f in df.schema.fields])


def null_pct(df: DataFrame) -> DataFrame:
    """Per column, percentage of missing cells (null when no rows)."""
    return df.selectExpr(*[
        f"try_divide(count_if({_missing_sql(f.name, f.dataType)}) * 100.0D, count(1))"
        f" AS {_q(f.name)}" for f in df.schema.fields])


def sparse_columns(df: DataFrame, threshold_pct: float = 70.0) -> list[str]:
    """Columns whose missing share is strictly above ``threshold_pct``.

    One job with a one-row result (bounded by the column count).
    """
    row = null_pct(df).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold_pct]


def drop_sparse_columns(df: DataFrame, threshold_pct: float = 70.0) -> DataFrame:
    """Drop columns with more than ``threshold_pct`` % missing (strict ``>``)."""
    cols = sparse_columns(df, threshold_pct)
    return df.drop(*cols) if cols else df


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named helper columns; a name that is not there is an
    error, never silently nothing (``drop`` ignores it)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
    return df.drop(*names)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows missing any value in ``subset`` (all columns if None)."""
    return df.na.drop(how="any", subset=None if subset is None else list(subset)) if subset is None or subset else df


def fill_group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    max_groups: int | None = None) -> DataFrame:
    """Fill gaps in ``cols`` with the mean of their group (``keys``).

    Plan: partial+final ``avg`` per group (hot keys are absorbed by the
    map-side combine), then a left join of the rows to the group means.
    The means are checkpointed and measured when this function is called
    (one job); they are broadcast only within ``max_groups`` rows and the
    byte bound of :func:`join_bounded`, otherwise it is a shuffle join that
    AQE can split for skewed keys.  No window over the whole group, so no
    task ever holds a whole hot group.

    A group with no value stays null; a row with a null key is not filled
    (pandas ``transform('mean')`` and the notebook's left join agree).
    Output keeps the input column order; filled columns become double.  No
    ``cols`` is nothing to do, without a job.
    """
    keys, cols = list(keys), list(cols)
    if not cols:
        return df
    tmp = {c: f"__mean_{c}" for c in cols}
    means = df.groupBy(*keys).agg(*[F.avg(_value(df, c)).alias(tmp[c]) for c in cols])
    joined = join_bounded(df, means, keys, how="left", max_rows=max_groups)
    out = [F.coalesce(_value(joined, c).cast("double"), F.col(tmp[c])).alias(c) if c in tmp
           else F.col(c) for c in df.columns]
    return joined.select(out)


def group_mean(df: DataFrame, keys: Sequence[str], col: str, name: str | None = None,
               max_groups: int | None = None) -> DataFrame:
    """the group mean of ``col`` kept on every row (``transform('mean')``).

    Same aggregate + bounded join as :func:`fill_group_mean` instead of a
    window partitioned by the key, which would put a hot group in one task.
    """
    keys = list(keys)
    name = name or f"mean_{col}"
    means = df.groupBy(*keys).agg(F.avg(_value(df, col)).alias(name))
    joined = join_bounded(df, means, keys, how="left", max_rows=max_groups)
    return joined.select(*[F.col(c) for c in df.columns], F.col(name))


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill gaps with the column's global mean.

    The means are one aggregate row (bounded by the column count), brought
    to the driver and applied as literals: no cross join, no window over
    the whole frame.
    """
    cols = list(cols)
    row = df.agg(*[F.avg(_value(df, c)).alias(c) for c in cols]).first()
    return df.select([
        F.coalesce(_value(df, c).cast("double"), F.lit(row[c]).cast("double")).alias(c)
        if c in cols else F.col(c) for c in df.columns])


def column_profile(df: DataFrame) -> DataFrame:
    """A5: column_name, data_type, non_null (one aggregation, then unpivot); NaN
    counts as missing, as in the null counts."""
    fields = df.schema.fields
    counts = df.selectExpr(*[
        f"count_if(NOT ({_missing_sql(f.name, f.dataType)})) AS c{i}" for i, f in enumerate(fields)])
    rows = ", ".join(
        f"named_struct('column_name', {_lit(f.name)}, 'data_type', "
        f"{_lit(f.dataType.simpleString())}, 'non_null', c{i})" for i, f in enumerate(fields))
    return counts.selectExpr(f"inline(array({rows}))")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A4: the first ``n`` rows (``head``/``show``) as a frame; a limit is
    the feature here.  Spark stops scanning once ``n`` rows are found."""
    return df.limit(n)


def distinct_values(df: DataFrame, where: Column | str, cols: Sequence[str]) -> DataFrame:
    """Distinct ``cols`` among rows matching ``where``."""
    return df.where(where).select(*cols).distinct()


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows that differ, with ``times``: how often more ``a`` holds the
    row than ``b`` (negative: less often).  Rows equal as often are left out.

    A signed multiset difference: +1 for each row of ``a``, -1 for each of
    ``b``, one sum per distinct row.  The sum is a partial aggregate, so a row
    that a third of a frame repeats is one row per task, and both frames meet in
    one shuffle.  Nulls equal nulls and NaN equals NaN.  ``b`` needs the columns
    of ``a`` by name, in any order; a common type is taken as ``unionByName`` does.
    """
    if sorted(a.columns) != sorted(b.columns) or "times" in a.columns:
        raise ValueError(f"cannot compare columns {a.columns} with {b.columns}")
    both = a.withColumn("times", F.lit(1)).unionByName(b.withColumn("times", F.lit(-1)))
    return (both.groupBy(*[F.col(_q(c)) for c in a.columns]).agg(F.sum("times").alias("times"))
            .where("times <> 0"))


def frames_equal(a: DataFrame, b: DataFrame) -> bool:
    """Same rows with the same multiplicities (order ignored)."""
    return frame_difference(a, b).isEmpty()


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the one with the greatest ``order`` values.

    An aggregate over an ordered struct (``max_by``), not a window: each task
    keeps one row per key, so a key with a third of all rows is never gathered
    or sorted in one task.  Null order values come before all others; rows that
    tie on every one are told apart by their columns in input order, so the
    choice does not depend on the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(_q(c)) for c in rest])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order, row)).alias("__best"))
    return best.select(*[F.col(_q(c)) if c in keys else F.col(f"__best.{_q(c)}").alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (a join on them would multiply rows)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))
