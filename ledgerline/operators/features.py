"""Store-day features for anomaly detection.

* ``store_day_features``: one row per store and day (a star join and one
  grouped aggregate; partial aggregation happens map side).
* ``rolling_features``: a 7-*row* trailing mean per store (days without sales
  are skipped, so the frame counts rows, not calendar days), NULL until three
  rows are available, plus the deviation from it.
* ``feature_stats`` / ``scale_features``: z-scores with the population
  standard deviation, from one aggregate row.

Measures stay exact decimals until they are published.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import dbl, nonzero, round_dbl
from ledgerline.operators.broadcast import Sized
from ledgerline.operators.star import Star
from ledgerline.schema import FEATURE_COLUMNS, STORE_DAY_KEYS

ROLL_ROWS = 7
ROLL_MIN_ROWS = 3
ROLLED = ("net_revenue", "txn_count")


def store_day_features(star: Star) -> DataFrame:
    """One row per store and day.  The fact is summed by its own two keys
    first, so what is shuffled and joined is one row per store key and day;
    the second level adds up store keys that share a store and city."""
    s = Sized(star.dim_store.df.select("store_key", "store_id", "city"), star.dim_store.rows).for_join()
    d = Sized(
        star.dim_date.df.select("date_key", "full_date", "year", "month", "day_of_week", "is_weekend"),
        star.dim_date.rows,
    ).for_join()
    by_key = star.fact_sales.groupBy("store_key", "date_key").agg(
        F.count("transaction_id").alias("txn_count"),
        F.sum("net_revenue").alias("net"),
        F.count("net_revenue").alias("n_net"),
        F.sum("discount_rate").alias("rate"),
        F.count("discount_rate").alias("n_rate"),
        F.sum("margin").alias("margin"),
    )
    grouped = by_key.join(s, "store_key").join(d, "date_key").groupBy(*STORE_DAY_KEYS).agg(
        F.sum("txn_count").alias("txn_count"),
        F.round(F.sum("net"), 2).alias("net_revenue"),
        F.round(_ratio("net", "n_net"), 2).alias("avg_basket"),
        F.round(_ratio("rate", "n_rate"), 4).alias("avg_discount_rate"),
        F.round(F.sum("margin"), 2).alias("total_margin"),
    )
    if star.txn_unique:
        return grouped
    # ids repeat: a store-day counts each of them once, whatever its keys
    ids = star.fact_sales.select("store_key", "date_key", "transaction_id").join(s, "store_key")
    ids = ids.groupBy("store_id", "city", "date_key").agg(F.count_distinct("transaction_id").alias("_txn"))
    ids = ids.join(d.select("date_key", "full_date"), "date_key").select(
        F.col("store_id").alias("_store"), F.col("city").alias("_city"), F.col("full_date").alias("_date"), "_txn"
    )
    same = F.col("store_id").eqNullSafe(F.col("_store")) & F.col("city").eqNullSafe(F.col("_city"))
    out = grouped.join(ids, same & (F.col("full_date") == F.col("_date")))
    return out.withColumn("txn_count", F.col("_txn")).drop("_store", "_city", "_date", "_txn")


def _ratio(total: str, count: str):
    """Mean from partial sums and counts (NULL where nothing was counted)."""
    return (dbl(F.sum(total)) / nonzero(F.sum(count))).cast("decimal(38,9)")


def rolling_features(daily: DataFrame) -> DataFrame:
    """Trailing 7-row mean per store ordered by date (min 3 rows) and deviation.

    The window partition is one store's days: bounded by the calendar, not by
    the number of transactions, even for a store with a third of all sales.
    """
    w = Window.partitionBy("store_id").orderBy("full_date", "city").rowsBetween(-(ROLL_ROWS - 1), 0)
    # all frame aggregates in one projection -> one Window operator
    framed = daily.select(
        "*",
        *[F.count(c).over(w).alias(f"_n_{c}") for c in ROLLED],
        *[F.sum(c).over(w).alias(f"_s_{c}") for c in ROLLED],
    )
    cols = [F.col(c) for c in daily.columns]
    for c in ROLLED:
        n = F.col(f"_n_{c}")
        mean = F.when(n >= ROLL_MIN_ROWS, dbl(f"_s_{c}") / nonzero(n))
        cols += [mean.alias(f"{c}_roll7"), (dbl(c) - mean).alias(f"{c}_deviation")]
    return framed.select(*cols)


def complete_features(df: DataFrame) -> DataFrame:
    """Rows whose four model features are all present."""
    cond = None
    for c in FEATURE_COLUMNS:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def feature_stats(df: DataFrame, cols=FEATURE_COLUMNS) -> dict[str, tuple[float, float]]:
    """Mean and population std per column, from one aggregate row.

    Sums are exact (decimal / integer); the mean and variance are then formed
    with a fixed sequence of double operations: E[x], E[x^2] - E[x]^2.
    A zero std scales by 1 (the feature is constant).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        x = _exact_operand(F.col(c), types[c])
        aggs.append(F.sum(x).alias(f"s_{c}"))
        aggs.append(F.sum(x * x).alias(f"q_{c}"))
    row = df.agg(*aggs).first()
    n = row["n"]
    stats = {}
    for c in cols:
        if not n:
            stats[c] = (0.0, 1.0)
            continue
        mean = float(row[f"s_{c}"]) / n
        var = float(row[f"q_{c}"]) / n - mean * mean
        std = math.sqrt(var) if var > 0 else 0.0
        stats[c] = (mean, std if std != 0 else 1.0)
    return stats


def _exact_operand(c, dtype):
    """A decimal narrow enough that ``x * x`` needs no precision loss
    (DECIMAL(38, s) squared would be rounded to 6 places)."""
    from pyspark.sql import types as T

    if isinstance(dtype, T.DecimalType):
        return c.cast(T.DecimalType(18, dtype.scale))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return c.cast(T.DecimalType(20, 0))
    return c.cast("double")


def scale_features(df: DataFrame, stats: dict[str, tuple[float, float]], prefix: str = "z_") -> DataFrame:
    cols = []
    for c, (mean, std) in stats.items():
        cols.append(((dbl(c) - F.lit(mean)) / F.lit(std)).alias(f"{prefix}{c}"))
    return df.select("*", *cols)


def scaled_features(daily: DataFrame) -> DataFrame:
    """Published z-scores (6 places) of the complete store-day rows."""
    complete = complete_features(daily)
    scaled = scale_features(complete, feature_stats(complete))
    return scaled.select(
        "store_id",
        "city",
        "full_date",
        *[round_dbl(f"z_{c}", 6).alias(f"z_{c}") for c in FEATURE_COLUMNS],
    )
