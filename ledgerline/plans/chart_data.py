"""Chart-ready tables (the drawing itself is left to the BI layer).

* ``waterfall_points``: one bar per category of the revenue decomposition,
  with colour, money label, label position and alignment.
* ``discount_scatter_points``: discount depth vs margin rate per category and
  bucket for one year, with a marker size scaled to the category's largest
  bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.labels import millions_label, sign_color
from ledgerline.functions.numeric import nonzero

LABEL_OFFSET_SHARE = 0.02
SIZE_SCALE = 300.0
SIZE_BASE = 40.0


def waterfall_points(revenue_decomposition: DataFrame) -> DataFrame:
    """Input is the decomposition mart (one row per category), so the global
    window below spans a result bounded by the number of categories."""
    delta = F.col("revenue_delta")
    max_abs = F.max(F.abs(delta)).over(Window.partitionBy())
    sign = F.when(delta >= 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return revenue_decomposition.select(
        "category",
        "revenue_delta",
        sign_color(delta).alias("bar_color"),
        millions_label(delta).alias("label"),
        (delta + (max_abs * F.lit(LABEL_OFFSET_SHARE)) * sign).alias("label_x"),
        F.when(delta >= 0, F.lit("left")).otherwise(F.lit("right")).alias("label_align"),
    ).orderBy("revenue_delta", "category")


def discount_scatter_points(discount_leakage: DataFrame, year: int) -> DataFrame:
    """Mean depth / mean margin rate / summed net revenue per (category,
    bucket) of ``year``; size = volume / category max * 300 + 40."""
    pts = (
        discount_leakage.filter(F.col("year") == year)
        .groupBy("category", "discount_bucket")
        .agg(
            F.avg("disc_pct_of_gross").alias("disc_pct"),
            F.avg("margin_rate_pct").alias("margin_rate"),
            F.sum("net_revenue").alias("volume"),
        )
    )
    cat_max = F.max("volume").over(Window.partitionBy("category"))
    return pts.withColumn(
        "marker_size", F.col("volume") / nonzero(cat_max) * F.lit(SIZE_SCALE) + F.lit(SIZE_BASE)
    ).orderBy("category", "discount_bucket")
