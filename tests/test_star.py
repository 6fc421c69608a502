"""Star schema builders: properties over generated sales, and edge cases."""

import datetime as dt

import pytest

from tests_support import make_raw, raw_row
from pyspark.sql import functions as F

from ledgerline.operators import star as S
from ledgerline.operators.broadcast import sized
from ledgerline.operators.sequence import with_row_index
from ledgerline.operators.validate import validate


def staged(spark, rows):
    return validate(make_raw(spark, rows))


def _star(spark, rows):
    return S.build_star(staged(spark, rows))


@pytest.fixture(scope="module")
def many(spark):
    """Sales of 9 stores and 23 products on scattered days, and their star."""
    start = dt.date(2023, 11, 20)
    rows = [
        raw_row(f"R{i}", start + dt.timedelta(days=(i * i) % 211), f"N{i % 9}", f"city{i % 9 // 2}", f"P{i % 23}",
                f"cat{i % 23 % 4}", "2.50", i % 5, "0.1", i, i * 0.1, i * 0.9, i * 0.3)
        for i in range(400)
    ]
    return rows, staged(spark, rows), _star(spark, rows)


def test_date_spine_has_every_day_between_the_extremes_once(many):
    rows, _, star = many
    days = sorted(r.full_date for r in star.dim_date.df.select("full_date").collect())
    first, last = min(r[1] for r in rows), max(r[1] for r in rows)
    assert days == [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]


def test_surrogate_keys_are_dense_over_the_natural_keys(many):
    rows, _, star = many
    for dim, key, natural, expected in (
        (star.dim_store.df, "store_key", ["store_id", "city"], {(r[2], r[3]) for r in rows}),
        (star.dim_product.df, "product_key", ["sku", "category"], {(r[5], r[6]) for r in rows}),
    ):
        got = dim.select(key, *natural).collect()
        assert sorted(r[0] for r in got) == list(range(1, len(expected) + 1))
        assert {tuple(r)[1:] for r in got} == expected


def test_fact_joined_back_to_its_dimensions_is_the_staging(many):
    _, raw, star = many
    back = star.fact_sales.join(star.dim_store.df, "store_key").join(star.dim_product.df, "product_key")
    back = back.join(star.dim_date.df, "date_key").withColumnRenamed("full_date", "txn_date")
    names = ["transaction_id", "txn_date", "store_id", "city", "sku", "category", "quantity", "net_revenue", "margin"]
    assert back.select(*names).exceptAll(raw.select(*names)).count() == 0
    assert raw.select(*names).exceptAll(back.select(*names)).count() == 0
    assert tuple(S.fk_null_audit(star.fact_sales).first()) == (0, 0, 0)


# --- edge cases -----------------------------------------------------------------
def test_calendar_attributes_of_2023_01_01(spark, sample_rows):
    rows = [list(sample_rows[0])]
    rows[0][1] = dt.date(2023, 1, 1)
    dim = S.build_dim_date(staged(spark, rows)).first().asDict()
    assert dim["date_key"] == 20230101
    assert dim["week"] == 52
    assert dim["day_of_week"] == "Sunday"
    assert dim["is_weekend"] is True
    assert dim["fiscal_quarter"] == "FY2023-Q1"
    assert dim["month_name"] == "January"


def test_store_with_two_cities_fans_out_and_is_detected(spark, sample_rows):
    rows = [list(r) for r in sample_rows]
    rows[2][3] = "Quayside"  # N7 now has two cities
    star = _star(spark, rows)
    assert star.fact_sales.count() == 5  # 3 rows, two of them joined twice
    dup = star.dim_store.df.groupBy("store_id").count().filter("count > 1").count()
    assert dup == 1


def test_surrogate_keys_follow_natural_order(spark, sample_rows):
    dim = S.build_dim_store(staged(spark, sample_rows)).orderBy("store_key").collect()
    assert [(r.store_key, r.store_id) for r in dim] == [(1, "N7"), (2, "N8")]


@pytest.mark.parametrize("parts", [9, None])
def test_row_index_is_dense_and_ordered_across_partitions(spark, parts):
    """Explicit range partitions, and AQE-coalesced ones (parts=None)."""
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5003).alias("v"))
    idx = with_row_index(df, [F.col("v")], "i", num_partitions=parts)
    rows = idx.orderBy("i").collect()
    assert [r.i for r in rows] == list(range(5000))
    vals = [r.v for r in rows]
    assert vals == sorted(vals)


def test_sized_broadcast_respects_limit(spark):
    small = sized(spark.range(10))
    assert "broadcast" in str(small.for_join()._jdf.queryExecution().logical()).lower() or small.rows == 10
    big = small.__class__(small.df, 10**9)
    assert big.for_join() is small.df


def test_txn_count_fast_path_only_without_fan_out(spark, sample_rows):
    from ledgerline.plans import marts

    clean = S.build_star(staged(spark, sample_rows))
    assert clean.txn_unique is True
    plan = marts.seasonality(clean)._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan.lower()

    rows = [list(r) for r in sample_rows]
    rows[2][3] = "Quayside"  # N7 with two cities: fact rows fan out
    fan = S.build_star(staged(spark, rows))
    assert fan.txn_unique is False
    season = {(r.month, r.category): r.txn_count for r in marts.seasonality(fan).collect()}
    # A-100 and A-102 are each joined twice, still counted once
    assert season[(2, "Toys")] == 1 and season[(5, "Toys")] == 1


def test_broadcast_limit_is_configurable(spark, sample_rows):
    from ledgerline.plans import marts

    spark.conf.set("ledgerline.maxBroadcastRows", "1")
    try:
        star = S.build_star(staged(spark, sample_rows))
        plan = marts.revenue_decomposition(star, 2023, 2024)._jdf.queryExecution().optimizedPlan().toString()
        # every dimension (2 products, 51 days) is over the 1-row limit
        assert plan.count("strategy=broadcast") == 0
        rows = marts.revenue_decomposition(star, 2023, 2024).collect()
        assert len(rows) == 2
    finally:
        spark.conf.unset("ledgerline.maxBroadcastRows")


def test_broadcast_bound_is_in_bytes_of_the_joined_columns(spark):
    from ledgerline.operators.broadcast import Sized, row_width

    narrow = spark.range(1).select(F.lit(1).alias("k"), F.lit("x").alias("c"))
    wide = narrow.select("*", *[F.lit("y").alias(f"s{i}") for i in range(20)])
    assert row_width(wide.schema) > row_width(narrow.schema)
    rows = 1_000_000
    limit = rows * row_width(narrow.schema)
    spark.conf.set("ledgerline.maxBroadcastBytes", str(limit))
    try:
        assert Sized(narrow, rows).fits_broadcast()
        assert not Sized(wide, rows).fits_broadcast()
    finally:
        spark.conf.unset("ledgerline.maxBroadcastBytes")


def test_offsets_of_20000_partitions_are_a_joined_table(spark):
    """The offsets are rows, so the plan does not grow with the partitions."""
    from ledgerline.operators.sequence import partition_offsets

    counts = spark.range(20_000).select(F.col("id").cast("int").alias("_ri_part"), (F.col("id") % 5).alias("_ri_cnt"))
    offsets = partition_offsets(counts)
    got = {r["_ri_part"]: r["_ri_before"] for r in offsets.collect()}
    running = 0
    for part in range(20_000):
        assert got[part] == running
        running += part % 5
    plan = with_row_index(spark.range(0, 5000, 1, 13), ["id"], "i", num_partitions=400)._jdf.queryExecution()
    assert "map(" not in plan.optimizedPlan().toString() and len(plan.executedPlan().toString()) < 20_000
