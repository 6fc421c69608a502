"""csv_roundtrip_staging: what the export of the whole feed takes of the disk."""

import glob
import time

import pytest
from pyspark.sql import functions as F
from tests_support import SF_SMOKE

from ledgerline.operators import validate as V
from ledgerline.plans import catalog
from ledgerline.plans.pipeline import Pipeline
from ledgerline.schema import ROW_SEQ
from ledgerline.session import SHUFFLE_CLEANUP, dropped_shuffles
from ledgerline.sources import adapter

NO_BROADCAST = {"ledgerline.maxBroadcastRows": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["broadcast", "beyond the bound"])
def bound(request, spark):
    if request.param != "broadcast":
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
    yield request.param
    for k in NO_BROADCAST:
        spark.conf.unset(k)


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Lines that come twice, lines without a part, a supplier or a date, and a
    part key that repeats."""
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{SF_SMOKE}/{name}.parquet")
        if name == "lineitem":
            key = F.col("l_orderkey")
            df = df.withColumns({
                c: F.when(key % m != 0, F.col(c))
                for c, m in (("l_partkey", 7), ("l_suppkey", 11), ("l_shipdate", 13), ("l_quantity", 17), ("l_tax", 19))
            })
            df = df.unionByName(df.filter(key % 5 == 0))
        if name == "part":
            df = df.unionByName(df.filter("p_partkey % 10 = 0"))
        df.write.parquet(f"{tmp_path}/{name}")
    return str(tmp_path)


def test_feed_in_order_has_the_rows_of_the_feed(spark, odd_tables, bound, monkeypatch):
    monkeypatch.setattr(adapter, "LINES_PER_PART", 1000)
    p = Pipeline(spark, odd_tables)
    got, want = V.conform(p.raw_in_order()), V.conform(p.raw)
    assert got.dtypes == want.dtypes and got.rdd.getNumPartitions() > 1
    rows = got.collect()  # by partition
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))
    assert [r[ROW_SEQ] for r in rows] == [r[ROW_SEQ] for r in want.orderBy(ROW_SEQ).collect()]


def test_feed_in_order_shuffles_no_texts(spark, monkeypatch):
    monkeypatch.setattr(adapter, "LINES_PER_PART", 1000)
    dealt = physical(Pipeline(spark, SF_SMOKE).raw_in_order()).split("Exchange rangepartitioning")
    assert len(dealt) == 2
    lines = dealt[1].partition("FileScan parquet")[0]
    assert "l_partkey" in lines
    for late in ("TXN", "p_type", "n_name", "r_name"):
        assert late in dealt[0] and late not in lines


def test_given_rows_are_put_in_order(spark):
    feed = V.conform(Pipeline(spark, SF_SMOKE).raw)
    got = Pipeline(spark, raw=feed.repartition(5)).raw_in_order().collect()
    assert [r[ROW_SEQ] for r in got] == [r[ROW_SEQ] for r in feed.orderBy(ROW_SEQ).collect()]


def test_export_is_compressed_and_loads_as_staging(spark, odd_tables, bound, monkeypatch):
    monkeypatch.setattr(adapter, "LINES_PER_PART", 1000)
    monkeypatch.setattr(catalog, "CSV_FILE_LINES", 300)
    got = sorted(map(str, catalog.csv_roundtrip_staging(spark, odd_tables).collect()))
    path = next(x for x in catalog._pipe(spark, odd_tables).materialized if "pos-csv" in x)
    files = glob.glob(path.removeprefix("file:") + "/part-*")
    assert len(files) > 6 and all(f.endswith(".csv.gz") for f in files)
    lines = spark.read.option("header", True).csv(path)
    assert lines.columns == V.RAW_COLUMNS and lines.count() == catalog._pipe(spark, odd_tables).raw.count()
    assert got == sorted(map(str, catalog.validated_staging(spark, odd_tables).collect()))
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_shuffle_files_go_with_the_write(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}

    before = shuffles()
    with dropped_shuffles(spark):
        spark.range(1000).repartition(4, "id").write.format("noop").mode("overwrite").save()
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
