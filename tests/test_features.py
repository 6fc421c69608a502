"""Rolling window, scaling and exact quantile."""

import datetime as dt
from decimal import Decimal
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.features import feature_stats, rolling_features
from ledgerline.operators.quantile import exact_quantile


def daily(spark, store_days):
    rows = []
    for store, days in store_days.items():
        for i, d in enumerate(days):
            rows.append((store, "C", d, i + 1, Decimal(10 * (i + 1))))
    return spark.createDataFrame(rows, "store_id string, city string, full_date date, txn_count long, net_revenue decimal(18,2)")


def test_rolling_needs_three_rows_and_spans_seven_rows(spark):
    base = dt.date(2024, 1, 1)
    # store A: 8 days with gaps (row frame, not calendar frame)
    days = [base + dt.timedelta(days=k * 3) for k in range(8)]
    out = rolling_features(daily(spark, {"A": days, "B": [base], "C": [base, base + dt.timedelta(1)]}))
    a = out.filter("store_id = 'A'").orderBy("full_date").collect()
    assert a[0].net_revenue_roll7 is None and a[1].net_revenue_roll7 is None
    assert a[2].net_revenue_roll7 == pytest.approx((10 + 20 + 30) / 3)
    assert a[7].net_revenue_roll7 == pytest.approx(sum(range(20, 90, 10)) / 7)  # days 2..8
    assert a[7].txn_count_deviation == pytest.approx(8 - sum(range(2, 9)) / 7)
    assert out.filter("store_id = 'B'").first().net_revenue_roll7 is None
    assert all(r.net_revenue_roll7 is None for r in out.filter("store_id = 'C'").collect())


def test_population_std_scaling(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x long")
    (mean, std) = feature_stats(df, ["x"])["x"]
    assert mean == 2.5 and std == pytest.approx(math.sqrt(1.25))


def test_constant_feature_scales_by_one(spark):
    df = spark.createDataFrame([(5,), (5,)], "x long")
    assert feature_stats(df, ["x"])["x"] == (5.0, 1.0)


@pytest.mark.parametrize("q", [0.0, 0.03, 0.5, 0.97, 1.0])
def test_exact_quantile_matches_linear_percentile(spark, q):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=2001).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(5)
    got = exact_quantile(df, "v", q)
    assert got == pytest.approx(float(np.percentile(vals, 100 * q)), abs=1e-12)


def test_exact_quantile_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantile(df, "v", 0.5) == 2.0


def test_exact_quantile_with_a_hot_value_spreads_over_partitions(spark):
    """A third of the rows share one value; the quantile stays exact and the
    range partitions stay balanced."""
    vals = [5.0] * 3000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(6)
    assert exact_quantile(df, "v", 0.03) == pytest.approx(float(np.percentile(vals, 3)))
    assert exact_quantile(df, "v", 0.5) == pytest.approx(float(np.percentile(vals, 50)))
    # the principle: with the tie-breaker, range partitions split the hot value
    ranged = df.select("v", F.monotonically_increasing_id().alias("_tie")).repartitionByRange(8, "v", "_tie")
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000


def test_shuffle_partition_suggestion_scales_with_input(spark):
    from tests_support import SF_SMOKE

    from ledgerline.session import input_bytes, suggest_shuffle_partitions

    paths = [f"{SF_SMOKE}/lineitem.parquet"]
    size = input_bytes(spark, paths)
    assert size > 0
    assert suggest_shuffle_partitions(spark, paths) == spark.sparkContext.defaultParallelism
    assert suggest_shuffle_partitions(spark, paths, target_bytes=max(1, size // 50)) >= 50


@pytest.mark.parametrize("q", [0.0, 0.03, 0.5, 0.999, 1.0])
def test_exact_quantile_by_selection(spark, q, monkeypatch):
    """Several passes, ties, wide ranges, infinities; no sort and no copy."""
    from ledgerline.operators import quantile as Q

    monkeypatch.setattr(Q, "BUCKETS", 8)
    monkeypatch.setattr(Q, "FEW", 3)
    rng = np.random.default_rng(2)
    for values in (
        rng.standard_normal(400),
        np.round(rng.standard_normal(300), 1),
        10.0 ** rng.uniform(-300, 300, 200) * rng.choice([-1, 1], 200),
        np.array([-1.7e308, 1.7e308, 0.0, 5e-324, 1e-310]),
        np.array([7.0]),
        np.concatenate([[-np.inf] * 3, rng.standard_normal(20), [np.inf] * 5]),
    ):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        ordered = np.sort(values)
        pos = (len(values) - 1) * q
        lo, hi = ordered[int(np.floor(pos))], ordered[int(np.ceil(pos))]
        want = lo if pos == int(pos) else lo + (hi - lo) * (pos - int(pos))
        got = exact_quantile(df, "v", q)
        assert got == want or np.isnan(want) and np.isnan(got)


def test_store_days_count_repeated_ids_once(spark):
    from tests_support import staging_rows

    from ledgerline.operators.features import store_day_features
    from ledgerline.operators.star import build_star

    rows = staging_rows(spark, 40)
    star = build_star(rows.unionByName(rows.limit(12)))
    got = {r.full_date: (r.txn_count, r.net_revenue) for r in store_day_features(star).collect()}
    assert not star.txn_unique and sum(n for n, _ in got.values()) == 40
    assert sum(x for _, x in got.values()) == 52 * star.fact_sales.first().net_revenue
