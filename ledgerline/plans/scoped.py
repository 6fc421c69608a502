"""Documented-only capabilities rebuilt as plain DataFrame jobs.

* ``region_scoped_sales``: the fact table seen through one region (province);
  a parameterised filter on the store dimension.  Real row-level security
  belongs to the catalog; this is the query a scoped view would run.
* ``margin_compression_share``: how much of the margin decline the worst
  stores account for (running share over stores whose margin fell).
* ``incremental_new_rows``: batch incremental load - rows of a new delivery
  whose ``transaction_id`` is not yet in staging, flagged when they arrive
  below the staging high-water date (late rows still load).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import dbl, nonzero, publish, round_dbl, round_dec
from ledgerline.operators.anti_join import new_rows
from ledgerline.operators.broadcast import Sized
from ledgerline.operators.materialize import materialize
from ledgerline.operators.star import Star
from ledgerline.operators.validate import validate
from ledgerline.plans.marts import _store_pivot


def region_scoped_sales(star: Star, region: str) -> DataFrame:
    stores = star.dim_store.df.filter(F.col("province") == region).select("store_key", "store_id", "city", "province")
    s = Sized(stores, star.dim_store.rows).for_join()
    return publish(
        star.fact_sales.join(s, "store_key").select(
            "transaction_id", "date_key", "store_id", "city", "province", "net_revenue", "margin"
        )
    )


def margin_compression_share(star: Star, base_year: int, compare_year: int) -> DataFrame:
    """Share of the total margin drop per store, largest drop first.

    Input rows are the store pivot (one row per store), so the windows below
    span a result bounded by the number of stores.
    """
    p = _store_pivot(star, base_year, compare_year).withColumn("delta", F.col("mb") - F.col("ma"))
    drops = p.filter(F.col("delta") < 0).withColumn("drop", -F.col("delta"))
    order = Window.orderBy(F.col("delta").asc(), F.col("store_id"), F.col("city"))
    total = F.sum("drop").over(Window.partitionBy())
    running = F.sum("drop").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return drops.select(
        "store_id",
        "city",
        round_dec("delta", 2).alias("margin_delta"),
        F.row_number().over(order).alias("drop_rank"),
        round_dbl(dbl("drop") * F.lit(100.0) / nonzero(dbl(total)), 2).alias("share_pct"),
        round_dbl(dbl(running) * F.lit(100.0) / nonzero(dbl(total)), 2).alias("cumulative_share_pct"),
    )


def incremental_new_rows(raw: DataFrame, cutoff: dt.date, overlap_days: int) -> DataFrame:
    """Two deliveries of the same feed: the first holds lines dated before
    ``cutoff`` and is already in staging; the second re-delivers from
    ``cutoff - overlap_days`` on.  Returns the second delivery's validated
    rows that staging does not hold yet.  The anti-join on
    ``transaction_id`` - not the date - decides, so late rows still load.
    """
    d = F.col("txn_date")
    raw = materialize(raw, "incr_feed")  # both deliveries are cut from one pass over the feed
    first = raw.filter(d < F.lit(cutoff))
    second = raw.filter(d >= F.lit(cutoff - dt.timedelta(days=overlap_days)))
    staging = materialize(validate(first), "incr_staging")
    hwm = staging.agg(F.max("txn_date")).first()[0]
    fresh = new_rows(validate(second), staging, "transaction_id")
    late = (d <= F.lit(hwm)) if hwm is not None else F.lit(False)
    return publish(fresh.withColumn("below_high_water", late))
