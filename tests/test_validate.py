"""Validation: each rule, their order, and edge cases."""

from decimal import Decimal

import pytest
from tests_support import make_raw
from pyspark.sql import functions as F

from ledgerline.functions.labels import discount_bucket
from ledgerline.operators import validate as V
from ledgerline.schema import RAW_COLUMNS


def col_of(df, tid, col):
    return df.filter(F.col("transaction_id") == tid).select(col).first()[0]


def test_validate_passes_clean_data(spark, sample_rows):
    assert V.validate(make_raw(spark, sample_rows)).count() == 3


def test_validate_drops_duplicates(spark, sample_rows):
    rows = sample_rows + [list(sample_rows[0])]
    assert V.validate(make_raw(spark, rows)).count() == 3


def test_validate_drops_null_key_fields(spark, sample_rows):
    sample_rows[0][12] = None  # net_revenue
    assert V.validate(make_raw(spark, sample_rows)).count() == 2


def test_validate_zeroes_negative_values(spark, sample_rows):
    sample_rows[1][12] = Decimal("-50")
    out = V.validate(make_raw(spark, sample_rows))
    assert col_of(out, "A-101", "net_revenue") == 0


def test_validate_clamps_discount_rate(spark, sample_rows):
    sample_rows[0][9] = Decimal("1.5")
    out = V.validate(make_raw(spark, sample_rows))
    assert col_of(out, "A-100", "discount_rate") == 1


def test_validate_raises_on_missing_columns(spark, sample_rows):
    df = make_raw(spark, sample_rows).drop("net_revenue")
    with pytest.raises(ValueError, match="missing columns"):
        V.validate(df)


# --- edge cases -----------------------------------------------------------------
def test_bad_first_copy_hides_good_second_copy(spark, sample_rows):
    bad = list(sample_rows[0])
    bad[12] = None
    rows = [bad] + sample_rows  # first copy of A-100 has a NULL net revenue
    out = V.validate(make_raw(spark, rows))
    assert out.count() == 2
    assert out.filter(F.col("transaction_id") == "A-100").count() == 0


def test_keep_first_keeps_file_order_not_value_order(spark, sample_rows):
    second = list(sample_rows[0])
    second[8] = 99  # a later copy with a different quantity
    rows = [list(sample_rows[0]), second, sample_rows[1], sample_rows[2]]
    out = V.validate(make_raw(spark, rows))
    assert col_of(out, "A-100", "quantity") == 4
    rows = [second, list(sample_rows[0]), sample_rows[1], sample_rows[2]]
    out = V.validate(make_raw(spark, rows))
    assert col_of(out, "A-100", "quantity") == 99


def test_null_measure_is_not_zeroed(spark, sample_rows):
    sample_rows[0][7] = None  # unit_price
    out = V.validate(make_raw(spark, sample_rows))
    assert col_of(out, "A-100", "unit_price") is None


def test_nan_rate_becomes_null_not_clamped(spark, sample_rows):
    df = make_raw(spark, sample_rows).withColumn(
        "discount_rate",
        F.when(F.col("transaction_id") == "A-100", F.lit(float("nan"))).otherwise(F.col("discount_rate").cast("double")),
    )
    out = V.validate(df)
    assert col_of(out, "A-100", "discount_rate") is None


def test_extra_columns_pass_and_order_is_irrelevant(spark, sample_rows):
    df = make_raw(spark, sample_rows).withColumn("till", F.lit("T9"))
    df = df.select(*reversed(df.columns))
    out = V.validate(df)
    assert out.count() == 3 and "till" in out.columns


def test_zeroing_does_not_recompute_other_measures(spark, sample_rows):
    sample_rows[1][12] = Decimal("-50")
    out = V.validate(make_raw(spark, sample_rows))
    assert col_of(out, "A-101", "margin") == Decimal("9.6")


@pytest.mark.parametrize(
    "rate,bucket",
    [("0", "0%"), ("0.001", "1–5%"), ("0.05", "1–5%"), ("0.10", "6–10%"), ("0.20", "11–20%"),
     ("0.201", ">20%"), (None, ">20%")],
)
def test_discount_bucket_edges(spark, rate, bucket):
    df = spark.createDataFrame([(None if rate is None else Decimal(rate),)], "r decimal(9,4)")
    assert df.select(discount_bucket(F.col("r"))).first()[0] == bucket


def test_dq_report_counts(spark, sample_rows):
    dup = list(sample_rows[0])
    neg = list(sample_rows[1])
    neg[13] = Decimal("-1")  # margin
    clamp = list(sample_rows[2])
    clamp[9] = Decimal("2")
    nullkey = list(sample_rows[2])
    nullkey[0] = "A-103"
    nullkey[2] = None  # store_id
    rows = [sample_rows[0], neg, clamp, dup, nullkey]
    r = V.dq_report(make_raw(spark, rows)).first().asDict()
    assert r["total_rows"] == 5
    assert r["duplicates_dropped"] == 1
    assert r["null_key_rows_dropped"] == 1
    assert r["zeroed_margin"] == 1
    assert r["rates_clamped"] == 1
    assert r["rows_accepted"] == 3
    assert r["rows_dropped"] == 2


def test_hot_key_dedup_is_aggregate_not_window(spark, sample_rows):
    """A key holding most rows is reduced map side (partial aggregate)."""
    rows = [list(sample_rows[0]) for _ in range(500)] + sample_rows[1:]
    df = make_raw(spark, rows).repartition(8)
    plan = V.dedup_first(V.conform(df))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert V.dedup_first(V.conform(df)).count() == 3


def test_raw_columns_constant():
    assert len(RAW_COLUMNS) == 14 and len(set(RAW_COLUMNS)) == 14
