"""Exact quantile (linear interpolation) without sorting or gathering the data.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, i.e. the whole column in one task for a global quantile.
Here the order statistic is found by selection: one pass counts the values in
``BUCKETS`` equal parts of their range, the next pass does the same inside the
part that holds the wanted rank, and so on.  A pass is a scan with a partial
aggregate; what it shuffles is one short row per part and task.  When the part
holds few values (or one value, however many rows share it), its values are
counted and the rank is read off.  Passes: the logarithm of the rows to the
base of ``BUCKETS``, two or three for billions of rows.

Interpolation: ``lo + (hi - lo) * frac`` at position ``(n - 1) * q`` (the
definition of numpy's "linear" method and SQL ``quantile_cont``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
FEW = 4096  # distinct values fetched at the end, with their counts


def _part(v: Column, lo: float, hi: float) -> Column:
    """Number of the part of [lo, hi] that holds v; never falls as v grows."""
    width = hi / BUCKETS - lo / BUCKETS  # no overflow for any finite range
    if width < 1e-300:
        return F.when(v > lo, F.lit(1)).otherwise(F.lit(0))
    return F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)).cast("int")


def _neighbours(values: DataFrame, k: int, n: int, lo: float, hi: float) -> tuple[float, float]:
    """The values of rank ``k`` and ``k + 1`` (0-based; the last one twice)."""
    v = F.col("v")
    below = 0  # values under lo
    while True:
        inside = values.filter(v.between(lo, hi))
        parts = inside.groupBy(_part(v, lo, hi).alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        for part in sorted(parts.collect(), key=lambda r: r["lo"]):  # at most BUCKETS rows
            if k < below + part["n"]:
                break
            below += part["n"]
        lo, hi = part["lo"], part["hi"]
        if lo == hi:
            counted = [(lo, part["n"])]
            break
        if part["n"] <= FEW:
            few = values.filter(v.between(lo, hi)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            counted = sorted((r["v"], r["n"]) for r in few.collect())  # at most FEW rows
            break
    ranked = []
    for value, count in counted:
        for rank in (k, k + 1):
            if below <= rank < below + count:
                ranked.append(value)
        below += count
    if len(ranked) < 2 and k + 1 < n:
        ranked.append(values.filter(v > F.lit(ranked[0])).agg(F.min("v")).first()[0])
    return ranked[0], ranked[-1]


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """The q-quantile of the values that are neither null nor NaN; ``df`` is
    scanned once per pass, so it should be a written table."""
    v = F.col("v")
    values = df.select(F.col(col).cast("double").alias("v")).filter(v.isNotNull() & ~F.isnan(v))
    finite = F.when(F.abs(v) < float("inf"), v)
    seen = values.agg(F.count(F.lit(1)).alias("n"), F.count_if(v == float("-inf")).alias("low"),
                      F.count_if(v == float("inf")).alias("high"), F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    n, low, high = seen["n"], seen["low"], seen["high"]
    if n == 0:
        return None
    pos = (n - 1) * q
    k = math.floor(pos)
    if k < low:
        a = float("-inf")
        b = a if k + 1 < low else seen["lo"] if low + high < n else float("inf") if high else a
    elif k >= n - high:
        a = b = float("inf")
    else:
        finite_values = values.filter(F.abs(v) < float("inf"))
        a, b = _neighbours(finite_values, k - low, n - low - high, seen["lo"], seen["hi"])
        if k + 1 == n - high and high:
            b = float("inf")
    if k == pos:
        return a
    return a + (b - a) * (pos - k)
