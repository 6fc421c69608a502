"""Mart shapes (golden headers), bucket order, cross-sums and year edge cases."""

from decimal import Decimal

import pytest
from tests_support import SAMPLE, make_raw, raw_row
from pyspark.sql import functions as F

from ledgerline.operators.star import build_star
from ledgerline.operators.validate import validate
from ledgerline.plans import chart_data, marts

ROWS_2023 = [
    raw_row("A-001", "2023-01-01", "N7", "Harbour", "TOY-9", "Toys", 12.5, 6, 0.2, 75, 15, 60, 20),
    raw_row("A-002", "2023-06-30", "N9", "Quayside", "PEN-1", "Pens", 50, 1, 0.15, 50, 7.5, 42.5, 20),
]


@pytest.fixture(scope="module")
def star(spark):
    return build_star(validate(make_raw(spark, [list(r) for r in SAMPLE + ROWS_2023])))


def test_golden_headers(star):
    assert marts.revenue_decomposition(star, 2023, 2024).columns == [
        "category", "rev_2023", "rev_2024", "revenue_delta", "pct_change",
        "margin_2023", "margin_2024", "margin_pct_change"]
    assert marts.store_pl(star, 2023, 2024).columns == [
        "store_id", "city", "rev_2023", "rev_2024", "rev_delta", "rev_pct", "margin_2023", "margin_2024",
        "margin_pct", "avg_disc_pct_2023", "avg_disc_pct_2024", "disc_depth_change_pp"]
    assert marts.discount_leakage(star).columns == [
        "category", "year", "discount_bucket", "txn_count", "gross_revenue", "discount_given",
        "net_revenue", "total_margin", "disc_pct_of_gross", "margin_rate_pct"]
    assert marts.seasonality(star).columns == [
        "year", "month", "month_name", "category", "txn_count", "units_sold", "net_revenue",
        "total_margin", "avg_basket_value"]


def test_category_in_one_year_only_gives_zero_and_null_pct(star):
    rows = {r.category: r for r in marts.revenue_decomposition(star, 2023, 2024).collect()}
    hw = rows["Books"]  # sold in 2024 only
    assert hw.rev_2023 == 0 and hw.pct_change is None and hw.rev_2024 == pytest.approx(28.8)
    ap = rows["Pens"]  # sold in 2023 only
    assert ap.rev_2024 == 0 and ap.pct_change == -100.0


def test_store_in_one_year_only_gives_null_delta(star):
    rows = {r.store_id: r for r in marts.store_pl(star, 2023, 2024).collect()}
    assert rows["N8"].rev_2023 is None and rows["N8"].rev_delta is None and rows["N8"].rev_pct is None
    assert rows["N9"].rev_2024 is None and rows["N9"].margin_pct is None
    s01 = rows["N7"]
    assert s01.rev_delta == pytest.approx(50 + 100 - 60)
    # NULL margin_pct sorts first
    order = [r.store_id for r in marts.store_pl(star, 2023, 2024).collect()]
    assert order[:2] == ["N8", "N9"]


def test_bucket_byte_order_and_cross_sums(star):
    leak = marts.discount_leakage(star).collect()
    keys = [(r.category, r.year, r.discount_bucket) for r in leak]
    assert keys == sorted(keys)  # byte order of buckets within a category-year
    assert sorted(["0%", "1–5%", "6–10%", "11–20%", ">20%"]) == ["0%", "11–20%", "1–5%", "6–10%", ">20%"]
    total = sum(r.txn_count for r in leak)
    assert total == star.fact_sales.count()
    by_cat = {}
    for r in leak:
        by_cat[r.category] = by_cat.get(r.category, 0) + r.txn_count
    season = marts.seasonality(star).groupBy("category").agg(F.sum("txn_count").alias("n")).collect()
    assert {r.category: r.n for r in season} == by_cat


def test_avg_discount_skips_nulls(spark):
    rows = [list(r) for r in SAMPLE]
    rows[2][9] = None  # A-102 rate NULL -> not in the N7 average
    star = build_star(validate(make_raw(spark, rows)))
    s01 = [r for r in marts.store_pl_yearly(star).collect() if r.store_id == "N7"][0]
    assert s01.avg_discount_rate == 0.0 and s01.txn_count == 2


def test_waterfall_labels_and_offsets(star):
    pts = {r.category: r for r in chart_data.waterfall_points(marts.revenue_decomposition(star, 2023, 2024)).collect()}
    el = pts["Toys"]
    assert el.bar_color == "#27ae60" and el.label_align == "left" and el.label == "$+0.0M"
    ap = pts["Pens"]
    assert ap.bar_color == "#c0392b" and ap.label_align == "right" and ap.label == "$-0.0M"
    max_abs = max(abs(p.revenue_delta) for p in pts.values())
    assert ap.label_x == pytest.approx(ap.revenue_delta - 0.02 * max_abs)


def test_scatter_sizes_scale_to_category_max(star):
    pts = chart_data.discount_scatter_points(marts.discount_leakage(star), 2024).collect()
    el = [p for p in pts if p.category == "Toys"]
    assert max(p.marker_size for p in el) == pytest.approx(340.0)
    assert all(40.0 <= p.marker_size <= 340.0 for p in pts)


def test_decimal_inputs_stay_exact(spark):
    rows = [list(SAMPLE[0]) for _ in range(3)]
    for i, r in enumerate(rows):
        r[0] = f"T{i}"
        r[12] = Decimal("0.1")
    star = build_star(validate(make_raw(spark, rows)))
    r = marts.revenue_decomposition(star, 2023, 2024).first()
    assert r.rev_2024 == 0.3  # exact decimal sum, not 0.30000000000000004
