"""The four analytic marts over the star schema (plus the store-year level).

Each mart is a DataFrame function of the star and the two comparison years;
year-suffixed output columns carry the years given.  Dimension joins are
inner (facts with unresolved keys drop out, as in the source SQL) and
broadcast only when the counted dimension size allows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.labels import discount_bucket
from ledgerline.functions.numeric import dbl, nonzero, pct_change, pct_of, round_dbl, round_dec
from ledgerline.operators.broadcast import Sized
from ledgerline.operators.star import Star


# The marts aggregate the fact by key and calendar month and join the
# dimensions to that partial result: the fact itself is shuffled once, as
# partial sums, however large the product dimension is.  A product dimension
# under the broadcast bound is joined before, so the sums are per category.
def _months(star: Star, date_cols: tuple[str, ...]) -> DataFrame:
    """The calendar's months (bounded by the calendar, not by the data)."""
    months = star.dim_date.df.select(F.expr("date_key div 100").alias("ym"), *date_cols).distinct()
    return Sized(months, star.dim_date.rows).for_join()


def _of_year(rows: DataFrame, column: str, year: int | None, scale: int) -> DataFrame:
    """Rows of one year, as a range on the stored column: pushed into the scan."""
    if year is None:
        return rows
    return rows.filter(F.col(column).between(year * scale, (year + 1) * scale - 1))


def _fact_months(star: Star, year: int | None = None) -> DataFrame:
    return _of_year(star.fact_sales, "date_key", year, 10000).withColumn("ym", F.expr("date_key div 100"))


def _partial(fact: DataFrame, keys: list[str], measures: tuple[str, ...]) -> DataFrame:
    """Sums, non-null counts, row and transaction counts per key."""
    return fact.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in measures],
        *[F.count(m).alias(f"n_{m}") for m in measures],
        F.count(F.lit(1)).alias("n_rows"),
        F.count("transaction_id").alias("n_txn"),
    )


def _mean(measure: str):
    return dbl(F.sum(measure)) / nonzero(F.sum(f"n_{measure}"))


def category_months(
    star: Star,
    measures: tuple[str, ...],
    date_cols: tuple[str, ...] = ("year",),
    extra: tuple[str, ...] = (),
    year: int | None = None,
) -> DataFrame:
    """Partial sums with their category and calendar columns (``extra`` may
    name the discount bucket); from stored partial sums where the star has
    them, so the fact is not read."""
    if star.parts:
        return _of_year(star.parts.category, "ym", year, 100).join(_months(star, date_cols), "ym")
    fact = _fact_months(star, year)
    if "discount_bucket" in extra:
        fact = fact.withColumn("discount_bucket", discount_bucket(F.col("discount_rate")))
    p = Sized(star.dim_product.df.select("product_key", "category"), star.dim_product.rows)
    if p.fits_broadcast():
        # a product and month hold few rows each, a category and month many:
        # joined on the map side, hardly anything is left to shuffle
        part = _partial(fact.join(p.for_join(), "product_key"), ["category", "ym", *extra], measures)
        return part.join(_months(star, date_cols), "ym")
    part = _partial(fact, ["product_key", "ym", *extra], measures)
    return part.join(p.for_join(), "product_key").join(_months(star, date_cols), "ym")


def store_months(star: Star, measures: tuple[str, ...]) -> DataFrame:
    """Partial sums with their store and year."""
    if star.parts:
        return star.parts.store.join(_months(star, ("year",)), "ym")
    part = _partial(_fact_months(star), ["store_key", "ym"], measures)
    s = Sized(star.dim_store.df.select("store_key", "store_id", "city"), star.dim_store.rows).for_join()
    return part.join(s, "store_key").join(_months(star, ("year",)), "ym")


def _distinct_txns(star: Star, dim: Sized, key: str, by: list[str], date_cols: tuple[str, ...]) -> DataFrame:
    """COUNT(DISTINCT transaction_id) per group, for a star in which ids
    repeat (distinct counts of months or keys do not add up)."""
    side = Sized(dim.df.select(key, *[c for c in by if c in dim.df.columns]), dim.rows).for_join()
    rows = _fact_months(star).select(key, "ym", "transaction_id").join(side, key).join(_months(star, date_cols), "ym")
    return rows.groupBy(*by).agg(F.count_distinct("transaction_id").alias("txn_count"))


def _with_txn_count(star: Star, grouped: DataFrame, dim: Sized, key: str, by: list[str], date_cols) -> DataFrame:
    if star.txn_unique:
        return grouped.withColumnRenamed("n_txn", "txn_count")
    counts = _distinct_txns(star, dim, key, by, date_cols).withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return grouped.drop("n_txn").join(counts, same).drop(*[f"_{c}" for c in by])


def revenue_decomposition(star: Star, base_year: int, compare_year: int) -> DataFrame:
    """Year-over-year net revenue and margin by category.

    Missing years count as 0 (the pivot uses ELSE 0), so the percentage is
    NULL when the base is 0.
    """
    a, b = base_year, compare_year
    yr = F.col("year")
    zero = F.lit(0).cast("decimal(18,4)")

    def year_sum(measure: str, y: int):
        return F.sum(F.when(yr == y, F.col(measure)).otherwise(zero))

    base = category_months(star, ("net_revenue", "margin")).groupBy("category").agg(
        year_sum("net_revenue", a).alias("ra"),
        year_sum("net_revenue", b).alias("rb"),
        year_sum("margin", a).alias("ma"),
        year_sum("margin", b).alias("mb"),
    )
    return base.select(
        "category",
        round_dec("ra", 2).alias(f"rev_{a}"),
        round_dec("rb", 2).alias(f"rev_{b}"),
        round_dec(F.col("rb") - F.col("ra"), 2).alias("revenue_delta"),
        pct_change("rb", "ra", 1).alias("pct_change"),
        round_dec("ma", 2).alias(f"margin_{a}"),
        round_dec("mb", 2).alias(f"margin_{b}"),
        pct_change("mb", "ma", 1).alias("margin_pct_change"),
    ).orderBy("revenue_delta", "category")


def _store_year(star: Star) -> DataFrame:
    """Store-year aggregates at full precision (internal level of store_pl)."""
    measures = ("quantity", "gross_revenue", "discount_amount", "net_revenue", "margin", "discount_rate")
    by = ["store_id", "city", "year"]
    grouped = store_months(star, measures).groupBy(*by).agg(
        F.sum("n_txn").alias("n_txn"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discount"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("margin").alias("total_margin"),
        _mean("discount_rate").alias("avg_discount_rate"),
    )
    return _with_txn_count(star, grouped, star.dim_store, "store_key", by, ("year",))


def store_pl_yearly(star: Star) -> DataFrame:
    """Published store-year level: volume, value and discount depth."""
    return _store_year(star).select(
        "store_id",
        "city",
        "year",
        "txn_count",
        "units_sold",
        round_dec("gross_revenue", 2).alias("gross_revenue"),
        round_dec("total_discount", 2).alias("total_discount"),
        round_dec("net_revenue", 2).alias("net_revenue"),
        round_dec("total_margin", 2).alias("total_margin"),
        round_dbl("avg_discount_rate", 6).alias("avg_discount_rate"),
    )


def _store_pivot(star: Star, base_year: int, compare_year: int) -> DataFrame:
    a, b = base_year, compare_year
    yr = F.col("year")

    def pick(measure: str, y: int):
        return F.max(F.when(yr == y, F.col(measure)))

    return _store_year(star).groupBy("store_id", "city").agg(
        pick("net_revenue", a).alias("ra"),
        pick("net_revenue", b).alias("rb"),
        pick("total_margin", a).alias("ma"),
        pick("total_margin", b).alias("mb"),
        pick("avg_discount_rate", a).alias("da"),
        pick("avg_discount_rate", b).alias("db"),
    )


def store_pl(star: Star, base_year: int, compare_year: int) -> DataFrame:
    """Store P&L: revenue, margin and discount depth, year over year.

    Missing years stay NULL (MAX(CASE) without ELSE), so deltas are NULL for a
    store open in one year only.
    """
    a, b = base_year, compare_year
    p = _store_pivot(star, a, b)
    return p.select(
        "store_id",
        "city",
        round_dec("ra", 0).alias(f"rev_{a}"),
        round_dec("rb", 0).alias(f"rev_{b}"),
        round_dec(F.col("rb") - F.col("ra"), 0).alias("rev_delta"),
        pct_change("rb", "ra", 1).alias("rev_pct"),
        round_dec("ma", 0).alias(f"margin_{a}"),
        round_dec("mb", 0).alias(f"margin_{b}"),
        pct_change("mb", "ma", 1).alias("margin_pct"),
        round_dbl(F.col("da") * 100, 2).alias(f"avg_disc_pct_{a}"),
        round_dbl(F.col("db") * 100, 2).alias(f"avg_disc_pct_{b}"),
        round_dbl((F.col("db") - F.col("da")) * 100, 2).alias("disc_depth_change_pp"),
    ).orderBy(F.col("margin_pct").asc_nulls_first(), "store_id", "city")


def _leakage_groups(star: Star, year: int | None) -> DataFrame:
    measures = ("gross_revenue", "discount_amount", "net_revenue", "margin")
    part = category_months(star, measures, extra=("discount_bucket",), year=year)
    return part.groupBy("category", "year", "discount_bucket").agg(
        F.sum("n_rows").alias("txn_count"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("discount_amount").alias("discount_given"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("margin").alias("total_margin"),
    )


def discount_leakage(star: Star, year: int | None = None) -> DataFrame:
    """Revenue given away and margin rate by category, year and discount
    depth; ``year`` reads that year's facts only."""
    return _leakage_groups(star, year).select(
        "category",
        "year",
        "discount_bucket",
        "txn_count",
        round_dec("gross_revenue", 0).alias("gross_revenue"),
        round_dec("discount_given", 0).alias("discount_given"),
        round_dec("net_revenue", 0).alias("net_revenue"),
        round_dec("total_margin", 0).alias("total_margin"),
        pct_of("discount_given", "gross_revenue", 1).alias("disc_pct_of_gross"),
        pct_of("total_margin", "net_revenue", 1).alias("margin_rate_pct"),
    ).orderBy("category", "year", "discount_bucket")


def seasonality(star: Star) -> DataFrame:
    """Monthly transactions, units, revenue and basket value by category."""
    dates = ("year", "month", "month_name")
    by = ["year", "month", "month_name", "category"]
    grouped = category_months(star, ("quantity", "net_revenue", "margin"), dates).groupBy(*by).agg(
        F.sum("n_txn").alias("n_txn"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        round_dec(F.sum("net_revenue"), 0).alias("net_revenue"),
        round_dec(F.sum("margin"), 0).alias("total_margin"),
        round_dbl(_mean("net_revenue"), 2).alias("avg_basket_value"),
    )
    out = _with_txn_count(star, grouped, star.dim_product, "product_key", by, dates)
    names = [*by, "txn_count", "units_sold", "net_revenue", "total_margin", "avg_basket_value"]
    return out.select(*names).orderBy("year", "month", "category")
