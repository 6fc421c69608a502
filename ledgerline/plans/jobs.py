"""The four pipeline jobs, parameterised functions instead of scripts.

    run_ingest   raw CSV (or any raw DataFrame) -> validated staging table
    run_star     staging -> dim_date, dim_store, dim_product, fact_sales
    run_marts    star -> four mart CSVs + chart tables
    run_anomaly  star -> watch-list CSV + table, top 10

Jobs hand over through written tables only, so each can run (and be retried)
on its own.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized, sized
from ledgerline.operators.materialize import materialize, release, tracking
from ledgerline.operators.star import Star, plan_star, unique_on
from ledgerline.operators.validate import dq_aggregates, finish_validation, first_copies
from ledgerline.plans import anomaly, chart_data, marts
from ledgerline.plans.pipeline import BASE_YEAR, COMPARE_YEAR
from ledgerline.schema import DIM_DATE_COLUMNS, DIM_PRODUCT_COLUMNS, DIM_STORE_COLUMNS, FACT_COLUMNS
from ledgerline.sinks import files
from ledgerline.sinks.writers import save_table, write_csv, write_staging, write_star
from ledgerline.sources.pos_csv import read_pos_csv


def run_ingest(spark: SparkSession, staging_path: str, src: str | None = None, raw: DataFrame | None = None) -> dict:
    """Validate the raw feed and replace the staging table.

    Returns the data-quality report (one row) as a dict.
    """
    if raw is None:
        raw = read_pos_csv(spark, src)
    temp: list[str] = []
    with tracking(temp):
        # keep-first once; the DQ report is counted while it is written
        seen = Observation()
        firsts = materialize(first_copies(raw).observe(seen, *dq_aggregates()), "ingest_firsts")
        write_staging(finish_validation(firsts), staging_path)
        report = seen.get
    release(spark, temp)
    return report


def run_star(spark: SparkSession, staging_path: str, star_path: str) -> dict[str, int]:
    """Build and publish the star; row counts and unresolved keys are counted
    while the tables are written."""
    staging = spark.read.parquet(staging_path).drop("loaded_at")
    temp: list[str] = []
    with tracking(temp):
        counts = write_star(plan_star(staging), star_path)
    release(spark, temp)  # intermediate tables
    unresolved = {k: n for k, n in counts.items() if k.startswith("null_")}
    if any(unresolved.values()):
        warnings.warn(f"unresolved foreign keys in fact_sales: {unresolved}", stacklevel=2)
    return counts


def load_star(spark: SparkSession, star_path: str) -> Star:
    """The published version of the star, as one whole.

    The row counts and the uniqueness of the transaction ids come with the
    version, so nothing is scanned.  A folder without a pointer (four plain
    tables) is read as it is; its dimensions are counted and its ids checked.
    """
    at = files.current(spark, star_path)
    base = at["path"] if at else star_path.rstrip("/")

    def read(name: str, columns: list[str]) -> DataFrame:
        return spark.read.parquet(f"{base}/{name}").select(*columns)

    dims = [read("dim_date", DIM_DATE_COLUMNS), read("dim_store", DIM_STORE_COLUMNS), read("dim_product", DIM_PRODUCT_COLUMNS)]
    fact = read("fact_sales", FACT_COLUMNS)
    if at is None:
        return Star(*map(sized, dims), fact, unique_on(fact, "transaction_id"))
    rows = at["meta"]["rows"]
    known = [Sized(d, rows[n]) for d, n in zip(dims, ("dim_date", "dim_store", "dim_product"), strict=True)]
    return Star(*known, fact, at["meta"]["txn_unique"], fact_rows=rows["fact_sales"])


def run_marts(
    spark: SparkSession,
    star_path: str,
    out_dir: str,
    base_year: int = BASE_YEAR,
    compare_year: int = COMPARE_YEAR,
) -> dict[str, int]:
    star = load_star(spark, star_path)
    counts: dict[str, int] = {}

    def export(name: str, df: DataFrame) -> DataFrame:
        """Write one result (bounded by the dimension cardinalities), count
        it on the way, and return it as stored."""
        seen = Observation()
        path = f"{out_dir.rstrip('/')}/{name}"
        write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, single_file=True)
        counts[name] = seen.get["rows"]
        return spark.read.option("header", True).schema(df.schema).csv(path)

    revenue = export("revenue_decomposition", marts.revenue_decomposition(star, base_year, compare_year))
    export("store_pl", marts.store_pl(star, base_year, compare_year))
    leakage = export("discount_leakage", marts.discount_leakage(star))
    export("seasonality", marts.seasonality(star))
    export("waterfall_points", chart_data.waterfall_points(revenue))
    export("discount_scatter_points", chart_data.discount_scatter_points(leakage, compare_year))
    return counts


def run_anomaly(
    spark: SparkSession,
    star_path: str,
    out_dir: str,
    table_name: str | None = "anomaly_watchlist",
    contamination: float = anomaly.CONTAMINATION,
) -> list[dict]:
    """Write the watch-list (CSV + table) and return the top 10 rows."""
    star = load_star(spark, star_path)
    base = out_dir.rstrip("/")
    temp: list[str] = []
    with tracking(temp):
        watch = anomaly.anomaly_watchlist(anomaly.anomaly_scores(star, contamination))
        table_path = f"{base}/{table_name or 'anomaly_watchlist'}_table"
        if table_name:
            save_table(watch, table_name, table_path)
        else:
            watch.write.mode("overwrite").parquet(table_path)
    release(spark, temp)  # forest samples, scores, quantile index
    written = spark.read.parquet(table_path)
    write_csv(written.orderBy("anomaly_score", "store_id", "full_date"), f"{base}/anomaly_watchlist")
    top = anomaly.watchlist_top10(written)
    return [r.asDict() for r in top.collect()]

