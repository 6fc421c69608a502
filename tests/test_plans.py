"""Plan shapes that the scale design depends on (regression guards)."""

import re

import pytest
from tests_support import SF_SMOKE
from pyspark.sql import functions as F

from ledgerline.operators import validate as V
from ledgerline.operators.features import rolling_features
from ledgerline.operators.sequence import with_row_index
from ledgerline.plans import catalog, marts


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipe(spark):
    return catalog.build(spark, SF_SMOKE)


@pytest.mark.parametrize("mart", ["revenue_decomposition", "store_pl", "discount_leakage", "seasonality"])
def test_marts_broadcast_dimensions_and_prune_columns(spark, pipe, mart):
    star = pipe.star
    df = {
        "revenue_decomposition": lambda: marts.revenue_decomposition(star, 1999, 2000),
        "store_pl": lambda: marts.store_pl(star, 1999, 2000),
        "discount_leakage": lambda: marts.discount_leakage(star),
        "seasonality": lambda: marts.seasonality(star),
    }[mart]()
    plan = physical(df)
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
    # no mart uses unit_price: the staging scan must not read it
    assert "unit_price" not in plan
    assert "FileScan parquet" in plan


def test_keep_first_is_partial_plus_final_aggregate(spark, pipe):
    plan = physical(V.dedup_first(V.conform(pipe.raw)))
    assert "Window" not in plan
    assert len(re.findall(r"SortAggregate|HashAggregate|ObjectHashAggregate", plan)) >= 2


def test_row_index_never_funnels_data_through_one_partition(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 97).alias("v"))
    plan = physical(with_row_index(df, [F.col("v")], "i"))
    assert "SinglePartition" not in plan
    assert "Window" not in plan


def test_rolling_window_shuffles_once_by_store(spark, pipe):
    plan = physical(rolling_features(pipe.store_days))
    assert plan.count("Exchange hashpartitioning(store_id") == 1
    assert plan.count("Window [") == 1


def test_unique_transactions_skip_the_distinct_aggregation(spark, pipe):
    plan = physical(marts.seasonality(pipe.star))
    assert pipe.star.txn_unique
    assert "count(distinct" not in plan.lower() and "partial_count(distinct" not in plan.lower()


@pytest.mark.parametrize("mart", ["revenue_decomposition", "store_pl", "discount_leakage", "seasonality"])
def test_marts_shuffle_the_fact_once_and_never_join_staging(spark, pipe, mart):
    """With broadcasts off, as for dimensions beyond the bound."""
    spark.conf.set("ledgerline.maxBroadcastRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = (1999, 2000) if mart in ("revenue_decomposition", "store_pl") else ()
        plan = physical(getattr(marts, mart)(pipe.star, *args))
    finally:
        spark.conf.unset("ledgerline.maxBroadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "sku" not in plan and "BroadcastHashJoin" not in plan
    # the fact's rows leave their scan through one partial aggregate
    keys = "store_key" if mart == "store_pl" else "product_key"
    assert len(re.findall(rf"HashAggregate\(keys=\[{keys}#\d+L?, .*partial_sum", plan)) == 1


def test_scatter_reads_one_year_of_the_fact(spark, pipe):
    plan = physical(marts.discount_leakage(pipe.star, 2000))
    assert "GreaterThanOrEqual(date_key,20000000)" in plan
