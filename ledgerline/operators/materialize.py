"""Cut lineage by writing a table into the shared checkpoint folder.

A parquet table (rather than ``DataFrame.checkpoint``'s row files) keeps
column pruning, filter pushdown and size statistics for the planner when the
result is read back.  The folder is the one the cluster names in
``spark.checkpoint.dir``; see :func:`ledgerline.session.ensure_checkpoint_dir`.

Intermediate tables can be large (the keep-first table is a copy of the
feed), so writers inside a :func:`tracking` block are recorded and can be
deleted with :func:`release` once the job's outputs are written.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir

_REGISTRY: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("ledgerline_materialized", default=None)
_TABLE = "table:"


def materialize(df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> DataFrame:
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/ledgerline-{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    registry = _REGISTRY.get()
    if registry is not None:
        registry.append(path)
    return spark.read.parquet(path)


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a table written after a shuffle: one per shuffle partition,
    so a task that holds one partition writes one bucket."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000))


def save_bucketed(
    df: DataFrame,
    path: str,
    key: str,
    buckets: int | None = None,
    sort_by: str | None = None,
    partition_by: str | None = None,
    table: str | None = None,
) -> str:
    """Write ``df`` as an external table bucketed by ``key`` and return the
    table's name.  Aggregates and joins on ``key`` over ``spark.table(name)``
    then need no Exchange on that side."""
    spark = df.sparkSession
    table = table or f"ledgerline_{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").bucketBy(buckets or bucket_count(spark), key)
    if sort_by:
        writer = writer.sortBy(sort_by)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("path", path).format("parquet").saveAsTable(table)
    return table


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """:func:`materialize` as a table bucketed by ``key``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-{name}-{uuid.uuid4().hex}"
    table = save_bucketed(df, path, key, buckets)
    registry = _REGISTRY.get()
    if registry is not None:
        registry += [f"{_TABLE}{table}", path]
    return spark.table(table)


@contextlib.contextmanager
def tracking(registry: list[str]):
    """Record the paths of tables materialised inside the block."""
    token = _REGISTRY.set(registry)
    try:
        yield registry
    finally:
        _REGISTRY.reset(token)


def release(spark: SparkSession, paths: list[str]) -> int:
    """Delete materialised tables (Hadoop FileSystem API, any scheme)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    deleted = 0
    while paths:
        entry = paths.pop()
        if entry.startswith(_TABLE):
            spark.sql(f"DROP TABLE IF EXISTS {entry.removeprefix(_TABLE)}")
            continue
        p = jvm.org.apache.hadoop.fs.Path(entry)
        if p.getFileSystem(conf).delete(p, True):
            deleted += 1
    return deleted
