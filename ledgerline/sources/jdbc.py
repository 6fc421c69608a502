"""Relational connector (the database-URL swap of the source pipeline).

Spark's built-in JDBC data source; the driver jar for the target database
must be on the classpath.  Reads are split into ``num_partitions`` range
queries on a numeric column so large tables load in parallel; writes go
through ``batchsize``-row inserts from every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    batchsize: int = 10_000,
) -> None:
    """Drop-and-replace (``overwrite``) or append, in ``batchsize`` chunks."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batchsize))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
