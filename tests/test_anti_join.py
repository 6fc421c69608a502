"""New rows of a delivery: broadcast semi-join path and shuffle fallback agree."""

import pytest

from ledgerline.operators.anti_join import new_rows


@pytest.mark.parametrize("limit", [None, "1"])
def test_new_rows_both_paths(spark, limit):
    target = spark.createDataFrame([(f"T{i}", i) for i in range(100)], "transaction_id string, v int")
    delivery = spark.createDataFrame(
        [("T5", 1), ("T150", 2), ("T99", 3), ("T200", 4), (None, 5)], "transaction_id string, v int"
    )
    if limit:
        spark.conf.set("ledgerline.maxBroadcastRows", limit)
    try:
        got = sorted(r.v for r in new_rows(delivery, target, "transaction_id").collect())
    finally:
        spark.conf.unset("ledgerline.maxBroadcastRows")
    # NULL keys never match, so the NULL-key row is new as with a plain anti-join
    assert got == [2, 4, 5]
    plain = sorted(r.v for r in delivery.join(target, "transaction_id", "left_anti").collect())
    assert got == plain


def test_bucketed_staging_is_not_shuffled_by_the_fallback_anti_join(spark, tmp_path_factory):
    import tempfile

    from pyspark.sql import functions as F

    from ledgerline.sinks.writers import register_staging_table, write_staging_table
    from tests_support import staging_rows

    path = tempfile.mkdtemp(prefix="ledgerline-bucketed-", dir="/tmp") + "/staging"
    write_staging_table(staging_rows(spark, 2000), "stg_bucketed_test", path, buckets=16)
    spark.sql("DROP TABLE stg_bucketed_test")  # as in a new session
    register_staging_table(spark, "stg_bucketed_test", path, buckets=16)
    target = spark.table("stg_bucketed_test")
    delivery = staging_rows(spark, 50, start=1990).drop("loaded_at")
    spark.conf.set("ledgerline.maxBroadcastRows", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = new_rows(delivery, target, "transaction_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = sorted(r.transaction_id for r in out.collect())
    finally:
        spark.conf.unset("ledgerline.maxBroadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stg_bucketed_test")
    assert rows == sorted(f"T{i}" for i in range(2000, 2040))
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1  # the delivery side only
    assert "Bucketed: true" in plan
