"""Star schema: dim_date, dim_store, dim_product around fact_sales."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.calendar import calendar_columns, date_key
from ledgerline.operators.broadcast import Sized, sized
from ledgerline.operators.hot_join import left_join
from ledgerline.operators.materialize import bucket_count, materialize, materialize_bucketed
from ledgerline.operators.sequence import with_row_index_counted
from ledgerline.schema import DIM_DATE_COLUMNS, FACT_COLUMNS


def build_dim_date(staging: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last transaction date.

    The min/max aggregate is one row; the spine has one row per day of the
    span, bounded by the calendar rather than by the data volume.
    """
    bounds = staging.agg(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def _dim_with_key(staging: DataFrame, natural: list[str], key: str) -> Sized:
    distinct = staging.select(*natural).distinct()
    keyed, rows = with_row_index_counted(distinct, [F.col(c).asc_nulls_first() for c in natural], key, start=1)
    # written: the marts read a plain table, not the numbering's join
    return Sized(materialize(keyed.select(F.col(key).cast("bigint").alias(key), *natural), key), rows)


def dim_store_sized(staging: DataFrame) -> Sized:
    return _dim_with_key(staging, ["store_id", "city", "province"], "store_key")


def dim_product_sized(staging: DataFrame) -> Sized:
    return _dim_with_key(staging, ["sku", "category"], "product_key")


def build_dim_store(staging: DataFrame) -> DataFrame:
    """Distinct (store_id, city, province) with a 1-based surrogate key.

    Keys are opaque; they follow the natural-key order so they are stable
    across runs and partitionings.  A store with two cities gets two rows
    (and would fan out the fact join), as in the source pipeline.
    """
    return dim_store_sized(staging).df


def build_dim_product(staging: DataFrame) -> DataFrame:
    """Distinct (sku, category) with a 1-based surrogate key."""
    return dim_product_sized(staging).df


def build_fact_sales(staging: DataFrame, dim_store: Sized | DataFrame, dim_product: Sized | DataFrame) -> DataFrame:
    """Fact rows: derived date key + left joins to the store and product keys.

    The date key is computed from the date (no dim_date lookup).  Dimension
    sides are broadcast only when their counted size allows it; beyond that
    the hot stores and products are split off before the shuffle.
    """
    out = staging.withColumn("date_key", date_key(F.col("txn_date")))
    out = _keyed(out, dim_store, ["store_key", "store_id"], "store_id")
    return _keyed(out, dim_product, ["product_key", "sku"], "sku").select(*FACT_COLUMNS)


def _keyed(rows: DataFrame, dim: Sized | DataFrame, cols: list[str], key: str) -> DataFrame:
    if isinstance(dim, Sized):
        return left_join(rows, Sized(dim.df.select(*cols), dim.rows), key)
    return rows.join(dim.select(*cols), key, "left")


def fk_null_audit(fact: DataFrame) -> DataFrame:
    """Unresolved foreign keys per key column (a warning, not an error)."""
    return fact.agg(
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in ("date_key", "store_key", "product_key")]
    )


@dataclass
class Parts:
    """Partial sums of the fact by month, the grain at which deliveries merge:
    ``category`` per (category, ym, discount_bucket) and ``store`` per
    (store_id, city, ym).  Both are bounded by the dimensions and the
    calendar.  They stand for the fact only while ids are unique and no store
    or product is ambiguous, so that counts and sums add up."""

    category: DataFrame
    store: DataFrame


@dataclass
class Star:
    dim_date: Sized
    dim_store: Sized
    dim_product: Sized
    fact_sales: DataFrame
    # True when the fact was checked to hold at most one row per
    # transaction_id (see ``unique_on``).  Then COUNT(DISTINCT transaction_id)
    # == COUNT(...) in every group, and the marts skip the distinct shuffle.
    # None: not checked yet (a fact that is still to be written).
    txn_unique: bool | None = False
    # Stored partial sums: the marts then read them instead of the fact.
    parts: Parts | None = None
    # Rows of the fact, counted while it was written.
    fact_rows: int | None = None

    def txn_count(self) -> Column:
        """COUNT(DISTINCT transaction_id), as a plain count when exact."""
        if self.txn_unique:
            return F.count("transaction_id")
        return F.count_distinct("transaction_id")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date.df,
            "dim_store": self.dim_store.df,
            "dim_product": self.dim_product.df,
            "fact_sales": self.fact_sales,
        }


def unique_on(df: DataFrame, key: str) -> bool:
    """No value of ``key`` occurs twice, by an aggregate over the key alone
    (NULLs may repeat: they are not counted).  Over a table bucketed by
    ``key`` it is decided bucket by bucket, without an Exchange on it."""
    worst = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"))
    return (worst.first()[0] or 0) <= 1


def plan_star(staging: DataFrame) -> Star:
    """The dimensions, keyed and written to the checkpoint folder, around a
    fact that is not computed yet: for a writer that stores it once, in its
    final layout (:func:`ledgerline.sinks.writers.write_star`)."""
    dim_date = sized(materialize(build_dim_date(staging), "dim_date").select(*DIM_DATE_COLUMNS))
    dim_store = dim_store_sized(staging)
    dim_product = dim_product_sized(staging)
    return Star(dim_date, dim_store, dim_product, build_fact_sales(staging, dim_store, dim_product), None)


def build_star(staging: DataFrame, clustered: bool = False) -> Star:
    """All four tables are written once to the checkpoint folder: the marts
    read the stored fact and never join staging again.

    ``staging`` should itself be materialised (a written table), so it is
    read, not recomputed, by each of the builders.  The fact is stored in
    buckets by ``transaction_id``, so its ids are checked without an Exchange;
    one shuffle deals it out, which ``clustered`` leaves out for staging that
    is itself stored in these buckets (the pipeline's is).
    """
    star = plan_star(staging)
    seen = Observation()
    fact = star.fact_sales if clustered else star.fact_sales.repartition(bucket_count(staging.sparkSession), "transaction_id")
    # counted in the task that writes the row, so a repeated stage adds nothing
    fact = fact.observe(seen, F.count(F.lit(1)).alias("rows"))
    star.fact_sales = materialize_bucketed(fact, "fact_sales", "transaction_id")
    star.fact_rows = seen.get["rows"]
    star.txn_unique = unique_on(star.fact_sales, "transaction_id")
    return star
