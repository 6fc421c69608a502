"""Label and bucket expressions used by the marts and chart tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_dbl

# --- fixed values: discount depth buckets ------------------------------------
# Upper bounds (inclusive) and labels; the dash is U+2013 EN DASH.
BUCKET_ZERO = "0%"
BUCKET_BOUNDS = [(0.05, "1–5%"), (0.10, "6–10%"), (0.20, "11–20%")]
BUCKET_ELSE = ">20%"

# --- fixed values: waterfall colours -----------------------------------------
NEGATIVE_COLOR = "#c0392b"
POSITIVE_COLOR = "#27ae60"
# -----------------------------------------------------------------------------


def discount_bucket(rate: Column) -> Column:
    """CASE bucket of a discount rate.

    Every comparison with a NULL rate is unknown, so NULL falls to '>20%'.
    """
    expr = F.when(rate == 0, F.lit(BUCKET_ZERO))
    for bound, label in BUCKET_BOUNDS:
        expr = expr.when(rate <= F.lit(bound).cast("decimal(9,4)"), F.lit(label))
    return expr.otherwise(F.lit(BUCKET_ELSE))


def sign_color(delta: Column) -> Column:
    return F.when(delta < 0, F.lit(NEGATIVE_COLOR)).otherwise(F.lit(POSITIVE_COLOR))


def millions_label(delta: Column) -> Column:
    """'$+1.2M' / '$-0.3M': value / 1e6 with an explicit sign and 1 decimal."""
    scaled = delta / F.lit(1e6)
    magnitude = F.abs(round_dbl(scaled, 1)).cast("decimal(38,1)").cast("string")
    sign = F.when(scaled < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(F.lit("$"), sign, magnitude, F.lit("M"))
