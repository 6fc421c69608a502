"""Joins beyond the broadcast bound with a third of the rows on one key."""

import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized
from ledgerline.operators.hot_join import left_join


@pytest.fixture
def no_broadcast(spark):
    conf = {"ledgerline.maxBroadcastRows": "1", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(spark, n=60_000):
    hot = F.when(F.col("id") % 3 == 0, F.lit("K7")).otherwise(F.concat(F.lit("K"), (F.col("id") % 9001).cast("string")))
    return spark.range(0, n, 1, 16).select("id", F.when(F.col("id") % 50 == 1, None).otherwise(hot).alias("sku"))


def test_no_task_gets_a_hot_key(spark, no_broadcast):
    fact = rows(spark)
    dim = spark.range(9001).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("sku"), F.col("id").alias("product_key"))
    plain = fact.join(dim, "sku", "left")
    split = left_join(fact, Sized(dim, 9001), "sku")

    def reads(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]

    assert max(reads(plain)) > 2 * statistics.median(reads(plain))  # what is avoided
    hot = F.col("sku") == "K7"  # the hot rows are not shuffled, the others are
    for part in (split.filter(hot), split.filter(~hot)):
        assert max(reads(part)) <= 2 * statistics.median(reads(part))
    assert split.columns == ["id", "sku", "product_key"]
    assert split.exceptAll(plain.select(split.columns)).count() == 0 == plain.select(split.columns).exceptAll(split).count()


def test_keys_with_several_or_no_dimension_rows(spark, no_broadcast):
    fact = rows(spark, 3000)
    dim = spark.createDataFrame([("K7", 1), ("K7", 2), ("K8", 3), ("none", 4)], "sku string, product_key long")
    split = left_join(fact, Sized(dim, 4), "sku")
    plain = fact.join(dim, "sku", "left").select(split.columns)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_the_star_is_the_same_beyond_the_bound(spark, no_broadcast):
    from tests_support import staging_rows

    from ledgerline.operators.star import build_star

    staging = staging_rows(spark, 200).withColumn("sku", F.when(F.expr("transaction_id LIKE '%1%'"), "K2").otherwise("K1"))
    star = build_star(staging)
    assert star.fact_rows == 200 and star.txn_unique
    got = star.fact_sales.join(star.dim_product.df, "product_key").groupBy("sku").count().collect()
    want = staging.groupBy("sku").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
