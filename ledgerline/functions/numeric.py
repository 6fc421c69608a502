"""Numeric column expressions shared by the marts and features.

Rules that keep results reproducible across engines and partitionings:

* money is summed as DECIMAL, rounded as DECIMAL, and only then cast to DOUBLE;
* ratios and averages cast both operands to DOUBLE, divide once, and round
  through a DECIMAL(38,9) cast so that rounding is HALF_UP on the decimal value
  rather than on the binary one;
* every division guards its denominator with NULLIF semantics, because ANSI
  mode raises on division by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x: Column | str) -> Column:
    return _c(x).cast("double")


def round_dec(x: Column | str, places: int) -> Column:
    """ROUND an exact decimal (HALF_UP) and publish it as DOUBLE."""
    return F.round(_c(x), places).cast("double")


def round_dbl(x: Column | str, places: int) -> Column:
    """ROUND a double HALF_UP on its decimal value, publish as DOUBLE."""
    return F.round(_c(x).cast("decimal(38,9)"), places).cast("double")


def nonzero(x: Column | str) -> Column:
    """NULLIF(x, 0)."""
    c = _c(x)
    return F.when(c != 0, c)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """DOUBLE num / NULLIF(den, 0)."""
    return dbl(num) / nonzero(dbl(den))


def pct_change(new: Column | str, old: Column | str, places: int = 1) -> Column:
    """ROUND((new - old) * 100.0 / NULLIF(old, 0), places), delta taken exactly."""
    delta = _c(new) - _c(old)
    return round_dbl(dbl(delta) * F.lit(100.0) / nonzero(dbl(old)), places)


def pct_of(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """ROUND(part * 100.0 / NULLIF(whole, 0), places)."""
    return round_dbl(dbl(part) * F.lit(100.0) / nonzero(dbl(whole)), places)


def exact_avg(x: Column | str) -> Column:
    """AVG that skips NULLs: DOUBLE(sum) / NULLIF(count, 0).

    ``sum`` stays exact on decimals; an all-NULL group yields NULL.
    """
    c = _c(x)
    return dbl(F.sum(c)) / nonzero(F.count(c))


def zero_if_negative(x: Column | str) -> Column:
    """Negative -> 0, NULL stays NULL (``greatest`` would turn NULL into 0)."""
    c = _c(x)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def publish(df):
    """Cast DECIMAL columns to DOUBLE for published results (sums stay exact
    upstream; the published value is the correctly rounded double)."""
    from pyspark.sql import types as T

    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
