"""Session helpers: a tuned builder and the shared checkpoint folder.

Library functions never build a session; they take DataFrames.  These
helpers are for tests, the bench and scripts.
"""

from __future__ import annotations

import atexit
import os
import uuid
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Settings every session gets from :func:`build_session`.  AQE re-plans
#: joins from runtime sizes, coalesces small shuffle partitions and splits
#: skewed join partitions; the session zone is pinned so NTZ arithmetic
#: never meets a zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of size-checked join sides are dropped once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "runway",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or None if unset.
    Reads only: nothing is set on the session."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext on the client
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when unset
    (tests and local runs)."""
    d = checkpoint_dir(spark)
    if d:
        return d
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the checkpoint folder, or else a folder in
    the session's warehouse, which executors share as well."""
    named = checkpoint_dir(spark)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def _remove(spark: SparkSession, path: str) -> None:
    """Remove scratch data when the driver ends; a failure is said, not hidden."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():  # nothing left to remove it with
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    try:
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as e:
        warnings.warn(f"scratch data stays at {path}: {type(e).__name__}")


#: Paths handed out within each open :func:`scratch_scope`, innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed at the end of the innermost
    :func:`scratch_scope`, or else when the session's driver ends.  Nothing is
    set on the session, so plans do not depend on it."""
    path = f"{shared_folder(spark)}/runway-scratch/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    else:
        atexit.register(_remove, spark, path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Frees the intermediate tables made inside when it ends: results of the
    scope must be written (to a path from outside) by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _remove(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: Parquet in the shared folder, read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``written(df)`` and aggregates of its rows that ride on the same job.
    All measures are null for a table that the optimizer knows to be empty: its
    observation is planned away."""
    seen = Observation(f"{name}_{uuid.uuid4().hex}")
    table = written(df.observe(seen, *[c.alias(k) for k, c in measures.items()]), name)
    try:
        return table, seen.get
    except Py4JJavaError:
        if table.head(1):
            raise
        return table, dict.fromkeys(measures)


def bucketed(df: DataFrame, keys: Sequence[str], name: str, buckets: int | None = None,
             compression: str = "zstd") -> DataFrame:
    """``df`` computed once: a table bucketed and sorted by ``keys`` in the
    shared folder.

    One shuffle deals the rows; joins and aggregates on ``keys`` after it read
    the buckets as they lie, without another exchange of this side.  Each task
    writes one file, as the shuffle deals by the same hash as the buckets.
    ``buckets`` is the session's number of shuffle partitions if not given.
    The table is the session's own (a fresh name); its entry goes when the driver
    ends, its files as those of any scratch path.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"runway_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("compression", compression)
       .option("path", scratch_path(spark, name)).saveAsTable(table))
    atexit.register(_forget, spark, table)
    return spark.table(table)


def _forget(spark: SparkSession, table: str) -> None:
    """Take a scratch table's entry out of the catalog; the session may have ended."""
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        spark.sql(f"DROP TABLE IF EXISTS {table}")
