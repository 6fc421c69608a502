"""Sinks: staging, star tables, CSV exports and catalog tables.

All writes are drop-and-replace (``overwrite``) like the source pipeline,
written in parallel by every task; ``max_records_per_file`` bounds file size
the way the source pipeline's insert chunks bounded its batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators.materialize import bucket_count, save_bucketed
from ledgerline.operators.star import Star, unique_on
from ledgerline.operators.validate import add_load_time
from ledgerline.schema import FACT_COLUMNS
from ledgerline.sinks import files

DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def write_staging(df: DataFrame, path: str, max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> None:
    """Validated rows + ``loaded_at`` -> parquet (replaces the previous load)."""
    (
        add_load_time(df)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


def write_staging_table(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    mode: str = "overwrite",
) -> None:
    """Staging as a catalog table bucketed (and sorted) by ``transaction_id``.

    Joins on ``transaction_id`` against it - the daily anti-join of a new
    delivery - then shuffle only the other side; the staging side is read
    bucket by bucket.  ``mode="append"`` adds a delivery with the same
    bucketing.
    """
    stamped = df if "loaded_at" in df.columns else add_load_time(df)
    (
        stamped.write.mode(mode)
        .bucketBy(buckets, "transaction_id")
        .sortBy("transaction_id")
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )


def register_staging_table(spark, table: str, path: str, buckets: int) -> None:
    """Re-attach a stored bucketed staging table to this session's catalog
    (a persistent metastore keeps it across sessions by itself)."""
    from ledgerline.operators.validate import STAGING_DDL

    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({STAGING_DDL}) USING parquet "
        f"CLUSTERED BY (transaction_id) SORTED BY (transaction_id) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )


def write_star(star: Star, base_path: str, clustered: bool = False, keep: int = files.KEEP) -> dict[str, int]:
    """Publish the four star tables as a new version under ``base_path``.

    The tables go into a folder of their own; the pointer file is switched
    last, so a reader sees one whole version, and a crash leaves the old one.
    The fact is written once in its final layout: partitioned by a
    storage-only ``year``, bucketed by ``transaction_id`` (an id is in one
    bucket, so the uniqueness check needs no Exchange) and sorted by day
    inside a bucket (date ranges prune row groups).  It is dealt to the
    buckets by one shuffle, which ``clustered`` leaves out for a fact that
    comes from a table in the same buckets.

    Row counts, unresolved keys and the uniqueness of the ids are kept with
    the pointer, for the version they hold for.  Returns the counts.
    """
    spark = star.fact_sales.sparkSession
    at = files.current(spark, base_path)
    version = files.new_version(spark, base_path)
    path = files.version_path(base_path, version)
    rows = {}
    for name, df in star.tables().items():
        if name == "fact_sales":
            continue
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        rows[name] = getattr(star, name).rows
    buckets = bucket_count(spark)
    seen = Observation()
    fact = star.fact_sales.select(*FACT_COLUMNS).withColumn("year", F.expr("date_key div 10000").cast("int"))
    if not clustered:
        fact = fact.repartition(buckets, "transaction_id")
    nulls = [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in ("date_key", "store_key", "product_key")]
    fact = fact.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls)
    table = save_bucketed(fact, f"{path}/fact_sales", "transaction_id", buckets, "date_key", "year")
    counted = seen.get
    unique = unique_on(spark.table(table), "transaction_id") if star.txn_unique is None else star.txn_unique
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
    rows["fact_sales"] = counted.pop("rows")
    meta = {"txn_unique": unique, "buckets": buckets, "rows": rows, "unresolved": counted}
    files.publish(spark, base_path, version, meta, at and at["version"])
    files.prune(spark, base_path, keep)
    return rows | counted


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line.  ``single_file`` funnels the rows through one
    task; use it only for results of bounded size (the marts)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop-and-replace a catalog table (external when ``path`` is given)."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
